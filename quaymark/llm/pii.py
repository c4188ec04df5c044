"""Personal data by weak supervision: labelers vote, EM weighs them, a classifier decides."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .spans import count, listing, spans

BASE = ("email", "ip", "card", "phone")
#: Kinds that only the method adds.
ADDED = ("email_like", "card_like", "phone_like", "ssn", "iban")
NAMES = [*BASE, *ADDED]
#: Between two digits, a space or hyphen stands as this in what card numbers are sought in.
JOINT = "\\u0001"

# Java syntax; possessive where nothing is to be given back, so that long runs take linear time.
EMAIL = "(?:(?<![A-Za-z0-9._%+-])|\\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++"
IP = "(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++"
CARD = f"[0-9][0-9{JOINT}]++"
PHONE = "\\+[0-9][\\x20().0-9-]+[0-9]"
EMAIL_LIKE = "[A-Za-z0-9._%+-]{1,64}\\x20?[\\[(](?:at|AT)[\\])]\\x20?[A-Za-z0-9-]{1,63}\\x20?[\\[(](?:dot|DOT)[\\])]\\x20?[A-Za-z]{2,24}"
PHONE_LIKE = "(?<![0-9+(.-])\\(?[0-9]{3}\\)?[\\x20.-][0-9]{3}[\\x20.-][0-9]{4}(?![0-9.-])"
SSN = "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IBAN = "(?<![A-Z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Z0-9])"

#: Words before a span that speak for its kind.
CONTEXT = {
    "email_like": "(?i)(mail|contact|write|reach|address|inbox)",
    "card_like": "(?i)(card|visa|credit|debit|master|amex|payment|pan|number)",
    "phone_like": "(?i)(tel|phone|call|fax|mobile|cell|dial|sms|text)", "ssn": "(?i)(ssn|social|security|tax|itin)",
    "iban": "(?i)(iban|bank|account|transfer|konto|swift|bic)",
}
#: Listed domain endings, issuers' beginnings, countries of account numbers.
ENDINGS = "com org net edu gov mil int info biz name pro io ai app dev co me tv de at ch fr be nl lu es pt it uk ie dk se no fi pl cz gr ru ua tr us ca mx br ar au nz jp cn in kr za eu"
COUNTRIES = "AD AE AL AT AZ BA BE BG BH BR CH CR CY CZ DE DK DO EE ES FI FO FR GB GE GI GL GR GT HR HU IE IL IS IT KW KZ LB LI LT LU LV MC MD ME MK MR MT MU NL NO PK PL PS PT QA RO RS SA SE SI SK SM TN TR UA VG XK"
GAZETTEER = {
    "email_like": f"(?i)(?<![A-Za-z])({ENDINGS.replace(' ', '|')})$",
    "card_like": "^(4|5[1-5]|2[2-7]|3[47]|30[0-5]|36|38|6011|64[4-9]|65|62|35)",
    "phone_like": "^\\(?(2[0-9]{2}|[3-9][0-9]{2})", "ssn": "^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
    "iban": f"^({COUNTRIES.replace(' ', '|')})",
}
#: The strict form of each kind: grouped as cards are printed, one separator throughout, and so on.
STRICT = {
    "email_like": "^[A-Za-z0-9][A-Za-z0-9._%+-]+\\x20?[\\[(](at|AT)[\\])]",
    "card_like": f"^[0-9]{{4}}{JOINT}[0-9]{{4}}{JOINT}[0-9]{{4}}{JOINT}[0-9]{{4}}$|^[0-9]{{4}}{JOINT}[0-9]{{6}}{JOINT}[0-9]{{5}}$|^[0-9]{{15,16}}$",
    "phone_like": "^\\([0-9]{3}\\)\\x20|^([0-9]{3})([.-])[0-9]{3}\\2", "ssn": "^(?!000|666|9)[0-9]{3}", "iban": "^.{15,34}$",
}
#: What stands right before a span: a sign that announces a value, or a word that does.
BEFORE = ("[:=#]\\s*$", "(?i)\\b(is|at|no|nr|num|number|my|your|the)\\s*$")


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check."""
    def part(i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 1, twice).otherwise(d)

    values = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), part)
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _card_length(hit: Column) -> Column:
    return F.length(_digits(hit)).between(14, 19)


def _is_card(hit: Column) -> Column:
    return F.when(_card_length(hit), luhn(_digits(hit))).otherwise(F.lit(False))


def _is_ip(hit: Column) -> Column:
    def small(x: Column) -> Column:
        bare = F.regexp_replace(x, "^0+(?=[0-9])", "")
        return F.when(F.length(bare) <= 3, bare.cast("int") <= 255).otherwise(F.lit(False))

    return F.forall(F.split(hit, "\\."), small)


def _is_phone(hit: Column) -> Column:
    return F.length(_digits(hit)).between(10, 15)


def base_spans(text: Column, joined: Column) -> Column:
    return F.concat(spans(text, EMAIL, 0), spans(text, IP, 1, _is_ip), spans(joined, CARD, 2, _is_card), spans(text, PHONE, 3, _is_phone))


def candidate_spans(text: Column, joined: Column) -> Column:
    """What might be personal data beyond the base rules: each to be voted on."""
    unlucky = lambda hit: _card_length(hit) & ~_is_card(hit)
    return F.concat(spans(text, EMAIL_LIKE, 4), spans(joined, CARD, 5, unlucky), spans(text, PHONE_LIKE, 6), spans(text, SSN, 7),
        spans(text, IBAN, 8))


@dataclass(frozen=True)
class Reliability:
    """By EM: a prior for each kind, and for each labeler how often it votes yes on true and on false spans."""

    prior: dict[int, float]
    yes: dict[tuple[int, int], tuple[float, float]]


def reliabilities(patterns: dict[tuple[int, int, int, int], int], rounds: int = 50) -> Reliability:
    """EM over counts of ``(kind, vote, vote, vote)``; a vote is 1, 0 (no) or -1 (none).

    Starts from labelers that are right four times in five; estimates are smoothed by two
    spans of that kind, so that kinds with few candidates stay near the start.
    """
    kinds = sorted({p[0] for p in patterns})
    prior = dict.fromkeys(kinds, 0.5)
    yes = {(k, j): (0.8, 0.2) for k in kinds for j in range(3)}
    for _ in range(rounds):
        post = {p: posterior(Reliability(prior, yes), p) for p in patterns}
        for k in kinds:
            mine = {p: n for p, n in patterns.items() if p[0] == k}
            total = sum(mine.values())
            true = sum(n * post[p] for p, n in mine.items())
            prior[k] = (true + 1) / (total + 2)
            for j in range(3):
                cast = {p: n for p, n in mine.items() if p[1 + j] >= 0}
                a, b = sum(n * post[p] for p, n in cast.items()), sum(n * (1 - post[p]) for p, n in cast.items())
                ya, yb = (sum(n * q(post[p]) for p, n in cast.items() if p[1 + j] == 1) for q in (lambda x: x, lambda x: 1 - x))
                new = ((ya + 1.6) / (a + 2), (yb + 0.4) / (b + 2))
                yes[k, j] = new if new[0] >= new[1] else (sum(new) / 2, sum(new) / 2)  # no labeler speaks against itself
    return Reliability(prior, yes)


def posterior(r: Reliability, p: tuple[int, int, int, int]) -> float:
    z = math.log(r.prior[p[0]] / (1 - r.prior[p[0]]))
    for j in range(3):
        if p[1 + j] >= 0:
            t, f = r.yes[p[0], j]
            z += math.log(t / f) if p[1 + j] else math.log((1 - t) / (1 - f))
    return 1 / (1 + math.exp(-z))


def classifier(cells: dict[tuple, int], r: Reliability) -> dict[tuple, float]:
    """The span classifier: naive Bayes on a span's kind, votes and shape, trained on EM's posteriors.

    ``cells`` counts ``(kind, vote, vote, vote, shape)``; the result scores each cell. The shape
    (length class, whether a letter or sign abuts, and what announces it) is what the labelers don't see.
    """
    true: dict[tuple, float] = {}
    false: dict[tuple, float] = {}
    for c, n in cells.items():
        q = posterior(r, c[:4])
        for key in ((c[0], None), (c[0], c[4])):
            true[key] = true.get(key, 0.0) + n * q
            false[key] = false.get(key, 0.0) + n * (1 - q)
    out = {}
    for c in cells:
        k = c[0]
        shapes = len({x[4] for x in cells if x[0] == k})
        lift = math.log((true[k, c[4]] + 1) / (true[k, None] + shapes)) - math.log((false[k, c[4]] + 1) / (false[k, None] + shapes))
        q = posterior(r, c[:4])
        z = math.log((q + 1e-9) / (1 - q + 1e-9)) + lift
        out[c] = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(0)).otherwise(F.lit(-1))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.9, whole: bool = False) -> DataFrame:
    """``(doc_id, found)`` for every document, with ``row``, all its columns, if ``whole``: base spans, and candidates
    that the classifier gives at least ``least``.

    Three labelers vote on each candidate: a regex (its strict form), a gazetteer (listed
    beginnings or endings) and a context (words before it). EM estimates their reliabilities from
    the counts of vote patterns over all documents; the driver sees only those counts, of
    which there are at most 27 for each of five kinds and eighteen shapes. Candidates that overlap a
    base span are not added.
    """
    names = ["row"] if whole else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        *[F.struct("*").alias(n) for n in names])
    text = F.col("text")
    joined = F.regexp_replace(F.translate(text, "\u0001", "\u0002"), "(?<=[0-9])[\\x20-](?=[0-9])", "\u0001")
    has = F.col("text").rlike("[0-9@]|[\\[(](?:at|AT)[\\])]")
    empty = F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,hit:string,left:string>>")
    # joined is made for texts with long digit runs alone
    cards = F.when(text.rlike("[0-9]"), joined).otherwise(F.lit(""))
    found = rows.select("doc_id", *names, F.when(has, base_spans(text, cards)).otherwise(empty).alias("base"),
        F.when(has, candidate_spans(text, cards)).otherwise(empty).alias("more"))
    apart = F.filter("more", lambda c: ~F.exists("base", lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])))
    found = written(found.select("doc_id", *names, "base", apart.alias("more")), "spans")
    one = found.select(F.explode("more").alias("s")).select("s.*")

    def cell(s) -> dict[str, Column]:
        """Votes and shape of a span, from its struct or from columns of those names."""
        get = (lambda k: F.col(k)) if s is None else (lambda k: s[k])
        kind, hit, left = get("kind"), get("hit"), get("left")
        regex = context = gazetteer = F.lit(-1)
        for k in range(4, 9):
            name = NAMES[k]
            strict, listed = hit.rlike(STRICT[name]), hit.rlike(GAZETTEER[name])
            if name == "iban":
                strict &= hit.rlike("[0-9]{6}")
            regex = F.when(kind == k, _vote(strict, ~strict)).otherwise(regex)
            context = F.when(kind == k, _vote(left.rlike(CONTEXT[name]), left.rlike("[0-9A-Za-z]{12}$"))).otherwise(context)
            gazetteer = F.when(kind == k, _vote(listed, ~listed)).otherwise(gazetteer)
        before = F.when(left.rlike(BEFORE[0]), 1).when(left.rlike(BEFORE[1]), 2).otherwise(0)
        shape = (before * 3 + F.least(F.lit(2), F.floor(F.length(hit) / 16))).cast("int") * 2 + left.rlike("[^\\s]$").cast("int")
        return {"kind": kind, "v0": regex, "v1": gazetteer, "v2": context, "shape": shape}

    counted = one.select(*[v.alias(k) for k, v in cell(None).items()]).groupBy("kind", "v0", "v1", "v2",
        "shape").agg(F.count("*").alias("n")).collect()
    cells = {(r["kind"], r["v0"], r["v1"], r["v2"], r["shape"]): r["n"] for r in counted}
    patterns: dict[tuple, int] = {}
    for c, n in cells.items():
        patterns[c[:4]] = patterns.get(c[:4], 0) + n
    scores = classifier(cells, reliabilities(patterns)) if cells else {}
    taken = sorted(c for c, s in scores.items() if s >= least)
    if taken:
        key = lambda s: F.concat_ws(",", *[v.cast("string") for v in cell(s).values()])
        added = F.filter("more", lambda s: key(s).isin([",".join(map(str, c)) for c in taken]))
    else:
        added = empty
    return found.select("doc_id", F.concat("base", added).alias("found"), *names)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of the base kinds, the digest of base spans, and all spans.

    Null and empty texts have none; a null doc_id is a document like any other; rows repeat.
    """
    found = find(docs, id_col, text_col)
    base = F.filter("found", lambda s: s["kind"] < len(BASE))
    return found.select("doc_id", *[count(F.col("found"), i).alias(f"n_{x}") for i, x in enumerate(BASE)],
                        F.sha2(listing(base, NAMES).cast("binary"), 256).alias("base_sha256"),
                        listing(F.col("found"), NAMES).alias("spans"))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by its kind in brackets; all columns stay.

    Where spans overlap, the first by start, then kind, is replaced and the others go with it whole.
    """
    found = find(docs, id_col, text_col, whole=True)
    label = F.array(*[F.lit(f"[{x.upper()}]") for x in NAMES])
    text = F.col("row")[text_col].cast("string")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        piece = F.concat(acc["out"], F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")),
            F.get(label, s["kind"]))
        beyond = F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] < acc["at"], beyond).otherwise(F.struct(s["stop"].alias("at"), piece.alias("out")))

    done = F.aggregate(F.array_sort("found"), start, step, lambda acc: F.concat(acc["out"],
        F.substr(text, (acc["at"] + 1).cast("int"), F.length(text))))
    clean = F.when(F.size("found") == 0, text).otherwise(done)
    return found.select(*[clean.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
