"""Secret scans with a trigram inverted index."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .spans import count, listing, spans


@dataclass(frozen=True)
class Rule:
    """``pattern`` in Java syntax; ``plain`` is what queries are derived from, if it differs."""

    name: str
    pattern: str
    plain: str | None = None
    group: int = 0
    least: int = 0


RULES = (
    Rule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", group=2, least=8),
    Rule("access", "AKIA[A-Z0-9]{12,}"),
    Rule("hex", "(?<![0-9a-f])[0-9a-f]{32,}+", "[0-9a-f]{32,}"),
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
)
BASE = ("assign", "access", "hex")


_TIMES = re.compile(r"(?:([?*+])|\{(\d+)(,?)(\d*)\})[?+]?")
_SIGNS = {"t": "\t", "n": "\n", "r": "\r", "f": "\f"}
Ways = list[list[str]]


def _atom(p: str, at: int) -> tuple[str, Ways, int]:
    """What stands at a place: ``literal``, ``group`` or ``other`` with its ways, and where it ends."""
    ch = p[at]
    if ch == "(":
        look = re.compile(r"\(\?(?:<?[=!])").match(p, at)
        head = re.compile(r"\((?:\?(?:[a-zA-Z-]*:|P?<[A-Za-z]\w*>|<?[=!]))?").match(p, at)
        flags = re.compile(r"\(\?[a-zA-Z-]+\)").match(p, at)
        if flags:
            return "nothing", [[""]], flags.end()
        ways, end = _runs(p, head.end())
        if end >= len(p):
            raise ValueError(f"unclosed group in {p!r}")
        return ("nothing", [[""]], end + 1) if look else ("group", ways, end + 1)
    if ch == "[":
        end = at + 2 if p[at + 1] != "^" else at + 3  # a bracket that comes first is one of the class
        while p[end] != "]":
            end += 2 if p[end] == "\\" else 1
        return "other", [["", ""]], end + 1
    if ch == "\\":
        code = re.compile(r"\\(?:x([0-9A-Fa-f]{2})|u([0-9A-Fa-f]{4}))").match(p, at)
        if code:
            return "literal", [[chr(int(code[1] or code[2], 16)).lower()]], code.end()
        if p[at + 1] in "bBAzZG":
            return "nothing", [[""]], at + 2
        if p[at + 1].isalnum() and p[at + 1] not in _SIGNS:
            return "other", [["", ""]], at + 2
        return "literal", [[_SIGNS.get(p[at + 1], p[at + 1]).lower()]], at + 2
    if ch in "^$":
        return "nothing", [[""]], at + 1
    return ("other", [["", ""]], at + 1) if ch == "." else ("literal", [[ch.lower()]], at + 1)


def _runs(p: str, at: int = 0) -> tuple[Ways, int]:
    """Ways through a regex from a place to the end of its group, each as the literal runs that any match of it contains.

    The last item of a way is a run that may still grow. Classes and repeats end a run; optional
    letters and alternatives make ways of their own. Also where the group ends.
    """
    done: Ways = []
    ways: Ways = [[""]]
    while at < len(p) and p[at] != ")":
        if p[at] == "|":
            done, ways, at = done + ways, [[""]], at + 1
            continue
        kind, inner, at = _atom(p, at)
        often = _TIMES.match(p, at)
        least, most = 1, 1
        if often:
            at = often.end()
            least, most = {"?": (0, 1), "*": (0, None), "+": (1, None)}.get(often[1]) or (int(often[2]),
                int(often[4]) if often[4] else None if often[3] else int(often[2]))
        if kind == "nothing":
            continue
        if least == 0:
            inner = [[""], *inner] if (kind, most) == ("literal", 1) else [["", ""]]
        elif (least, most) != (1, 1):
            inner = [[*w, ""] for w in inner]
        ways = [[*w[:-1], w[-1] + i[0], *i[1:]] for w in ways for i in inner]
    return done + ways, at


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """The Boolean trigram query of a regex: any of these sets must be there whole; None: no trigram is mandatory.

    Letters are taken in lower case, since the index folds case.
    """
    clauses = set()
    for way in _runs(pattern)[0]:
        grams = frozenset(run[i : i + 3] for run in way for i in range(len(run) - 2))
        if not grams:
            return None
        clauses.add(grams)
    return [c for c in sorted(clauses, key=sorted) if not any(other < c for other in clauses)]


def postings(docs: DataFrame, grams: list[str], per_block: int = 4096) -> DataFrame:
    """The index of ``docs(rid, text)`` for the trigrams of all queries: one row per block of
    documents, one column of document keys per trigram. No list is longer than a block. The
    index is a table in the shared folder, so that each rule's query reads it and not the texts.
    """
    blocks = max(1, docs.count() // per_block)
    low = docs.select("rid", F.lower("text").alias("low"))  # a column of its own: folded once, not for each trigram
    has = F.filter(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for i, g in enumerate(grams)]), lambda x: x.isNotNull())
    # the outer form: for the inner one the optimizer computes the array a second time, to filter on its size
    rows = low.select("rid", F.explode_outer(has).alias("g")).where("g is not null").select("g", "rid",
        F.pmod(F.shiftright("rid", 7), F.lit(blocks)).alias("block"))
    # a set: rows that repeat in id and text have one key, and are one posting
    return written(rows.groupBy("block").pivot("g", list(range(len(grams)))).agg(F.collect_set("rid")), "postings")


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]], grams: list[str]) -> DataFrame:
    """``(rid, rules array<int>)``: documents whose postings satisfy a rule's query."""

    def of(clause: frozenset[str]) -> Column:
        lists = [F.coalesce(F.col(f"`{grams.index(g)}`"), F.array().cast("array<bigint>")) for g in sorted(clause)]
        return reduce(F.array_intersect, lists)

    found = None
    for rule, clauses in queries.items():
        ids = reduce(F.array_union, [of(c) for c in clauses])
        part = index.select(F.explode(ids).alias("rid"), F.lit(rule).alias("rule"))
        found = part if found is None else found.unionByName(part)
    return found.groupBy("rid").agg(F.collect_set("rule").alias("rules"))


def secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, found)``: every document with the spans of all rules in its whole text.

    Rules with mandatory trigrams are verified where the index says that they may match;
    the others scan every text. Null and empty texts have no spans; repeated rows repeat;
    a null doc_id is a document like any other.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text"))
    queries = {i: q for i, r in enumerate(rules) if (q := trigram_query(r.plain or r.pattern)) is not None}
    grams = sorted({g for q in queries.values() for c in q for g in c})
    if queries:
        found = written(candidates(postings(rows.select("rid", "text"), grams), queries, grams), "candidates")
        rows = rows.join(found, "rid", "left")
    else:
        rows = rows.withColumn("rules", F.array().cast("array<int>"))
    text = F.col("text")
    parts = []
    for i, rule in enumerate(rules):
        keep = None
        if rule.least:
            keep = lambda hit, r=rule: F.length(F.regexp_extract(hit, r.pattern, r.group)) >= r.least
        part = spans(text, rule.pattern, i, keep)
        if i in queries:
            part = F.when(F.array_contains("rules", i),
                part).otherwise(F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,hit:string,left:string>>"))
        parts.append(part)
    return rows.select("doc_id", F.concat(*parts).alias("found"))


def secret_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: counts of the base kinds, the digest of base spans, and all spans.

    Spans of added rules that lie inside a base span's reach stay; base spans are never dropped.
    """
    names = [r.name for r in rules]
    base = [names.index(x) for x in BASE]
    found = secrets(docs, id_col, text_col, rules)
    own = F.filter("found", lambda s: s["kind"].isin(base))
    return found.select(
        "doc_id", *[count(F.col("found"), names.index(x)).alias(f"n_{x}") for x in BASE],
        F.sha2(listing(own, names).cast("binary"), 256).alias("base_sha256"), listing(F.col("found"), names).alias("spans"))
