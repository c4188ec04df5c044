"""Substring deduplication: suffixes partitioned by variable-length prefixes, a suffix tree for each group.

The suffixes are a sample that loses no repeat: each window of ``width`` words is represented by
the suffix that starts at its lowest-hashing few words, which equal windows have at the same
place. Suffixes are grouped by their own leading words, and the prefix is lengthened where a
group is large. Each group sorts all suffixes of its windows with their common prefix lengths;
the internal nodes of that tree that are ``width`` words deep or more are the repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import meet, partitions, written

#: Words of the prefixes that suffixes are grouped by, the shortest first; beyond the last, whole windows.
PREFIXES = (5, 10)
_MIX = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_LAST = 2**63 - 1


def heads(words: list[bytes], width: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The suffixes that stand for a document's windows: ``(prefix hash, first window, windows)``.

    A window of ``width`` words is represented by the suffix that starts at the ``length`` words
    within it that hash lowest (the leftmost such): equal windows, wherever they stand, have
    equal ones, and that prefix is what they are grouped by. Successive windows mostly share
    their suffix, and make one entry.
    """
    n = len(words)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    m = n - length + 1
    gram = np.zeros(m, np.uint64)
    for k in range(length):
        gram *= _MIX[0]
        gram += h[k : k + m] * _MIX[k % len(_MIX)]
    gram ^= gram >> np.uint64(31)
    gram *= _MIX[0]
    gram ^= gram >> np.uint64(29)
    reach, low = 1, np.arange(m)
    span = width - length + 1
    while reach < span:  # leftmost lowest of 1, 2, 4, ... places
        step = min(reach, span - reach)
        a, b = low[: len(low) - step], low[step:]
        low = np.where(gram[b] < gram[a], b, a)
        reach += step
    first = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    return gram[low[first]], first, np.diff(np.concatenate([first, [len(low)]]))


@dataclass
class Subtree:
    """The deep part of a suffix tree: internal nodes at least so many words deep, parents before children.

    Node i covers the suffixes ``lo[i] .. hi[i]-1`` of ``leaves``, in sorted order, that share ``depth[i]``
    words and no more; ``parent`` is -1 where the parent is less deep. ``leaf_node`` is each leaf's own node.
    """

    leaves: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    depth: np.ndarray
    parent: np.ndarray
    leaf_node: np.ndarray


def subtree(tokens: np.ndarray, starts: np.ndarray, least: int) -> Subtree:
    """The internal nodes at least ``least`` deep of the suffix tree over the suffixes at ``starts``.

    ``tokens`` are words as numbers; a text ends in a number that nothing else has, so that no
    common prefix goes beyond a text's end. Suffixes are ranked by 1, 2, 4, 8 and 16 words;
    those that share ``least`` words with another are then sorted whole, and neighbours' common
    prefixes give the nodes.
    """
    ranks = [np.unique(tokens, return_inverse=True)[1]]
    reach = 1
    while reach < 16:
        pair = ranks[-1] * (len(tokens) + 1)
        pair[: len(tokens) - reach] += ranks[-1][reach:] + 1
        ranks.append(np.unique(pair, return_inverse=True)[1])
        reach *= 2
    top, last = ranks[-1], len(tokens)

    def at(rank: np.ndarray, where: np.ndarray) -> np.ndarray:
        return np.where(where < last, rank[np.minimum(where, last - 1)], -1 - where)

    def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words the suffixes at ``a`` and ``b`` share."""
        n = np.zeros(len(a), np.int64)
        live = np.arange(len(a))
        while len(live):  # sixteen words at a time, then the rest
            live = live[at(top, a[live] + n[live]) == at(top, b[live] + n[live])]
            n[live] += 16
        for k in (3, 2, 1, 0):
            n += np.where(at(ranks[k], a + n) == at(ranks[k], b + n), 1 << k, 0)
        return n

    # what shares no ``least`` words with another suffix is in no deep node
    power = min(16, 1 << least.bit_length() - 1)
    keys = [at(ranks[power.bit_length() - 1], starts + k) for k in sorted({*range(0, least - power + 1, power), least - power})]
    by = np.lexsort(keys)
    same = np.logical_and.reduce([k[by[1:]] == k[by[:-1]] for k in keys]) if len(by) > 1 else np.zeros(0, bool)
    member = np.zeros(len(by), bool)
    member[1:] |= same
    member[:-1] |= same
    deep = starts[by[member]]
    keys, step = [], 0
    while len(deep):  # whole suffixes, sixteen words at a time until all differ
        keys.append(at(top, deep + step))
        step += 16
        order = np.lexsort(keys[::-1])
        if len(deep) < 2 or not np.logical_and.reduce([k[order[1:]] == k[order[:-1]] for k in keys]).any():
            deep = deep[order]
            break
    lcp = common(deep[:-1], deep[1:]) if len(deep) > 1 else np.zeros(0, np.int64)
    lo: list[int] = []
    hi: list[int] = []
    depth: list[int] = []
    parent: list[int] = []
    leaf = np.full(len(deep), -1, np.int64)
    stack: list[int] = []
    heights = lcp.tolist()
    for i, d in enumerate(heights):
        start = i
        below = -1
        while stack and depth[stack[-1]] > d:
            below = stack.pop()
            hi[below] = i + 1
            start = lo[below]
            if stack and depth[stack[-1]] >= max(d, least):
                parent[below] = stack[-1]
                below = -1
        if d >= least:
            if not stack or depth[stack[-1]] < d:
                lo.append(start)
                hi.append(0)
                depth.append(d)
                parent.append(-1)
                stack.append(len(lo) - 1)
                if below >= 0:
                    parent[below] = stack[-1]
            if leaf[i] < 0 or depth[leaf[i]] < d:
                leaf[i] = stack[-1]
            leaf[i + 1] = stack[-1]
    while stack:
        below = stack.pop()
        hi[below] = len(deep)
        if stack:
            parent[below] = stack[-1]
    return Subtree(deep, *(np.array(x, np.int64) for x in (lo, hi, depth, parent)), leaf)


def repeats(texts: list[bytes], starts: list[int], order: list[tuple], width: int) -> list[tuple[int, int, int]]:
    """What of one group repeats: ``(entry, first, end)`` ranges of words that also start earlier.

    ``texts[i]`` holds the words that the windows ``0 .. starts[i]-1`` of entry i span, and
    ``order[i]`` its document and place. Every window start is a suffix of its entry. A suffix that
    is not the earliest leaf of a node repeats the node's words; of its nodes, the deepest such
    gives the longest range.
    """
    ids: dict[bytes, int] = {}
    give = ids.setdefault
    tokens: list[int] = []
    offset = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        offset[i] = len(tokens)
        tokens += [give(w, len(ids)) for w in t.split(b" ")]
        tokens.append(-1 - i)
    count = np.array(starts, np.int64)
    entry = np.repeat(np.arange(len(texts)), count)
    inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    tree = subtree(np.array(tokens, np.int64), offset[entry] + inner, width)
    if not len(tree.lo):
        return []
    entry = np.searchsorted(offset, tree.leaves, side="right") - 1
    inner = tree.leaves - offset[entry]
    place = np.empty(len(texts), np.int64)
    place[sorted(range(len(texts)), key=order.__getitem__)] = np.arange(len(texts))
    rank = np.empty(len(entry), np.int64)  # leaves by document and place
    rank[np.lexsort((inner, place[entry]))] = np.arange(len(entry))
    least = np.full(len(tree.lo), len(rank), np.int64)
    np.minimum.at(least, tree.leaf_node, rank)
    for i in np.argsort(-tree.depth, kind="stable").tolist():  # children before parents
        if tree.parent[i] >= 0:
            least[tree.parent[i]] = min(least[tree.parent[i]], least[i])
    node = tree.leaf_node.copy()
    while True:
        up = (node >= 0) & (least[node] == rank)
        if not up.any():
            break
        node[up] = tree.parent[node[up]]
    late = np.flatnonzero(node >= 0)
    end = inner[late] + tree.depth[node[late]]
    # a range inside an earlier one of its entry says nothing new
    by = np.lexsort((inner[late], entry[late]))
    e, a, z = entry[late][by], inner[late][by], end[by]
    far = np.maximum.accumulate(z + e * (1 << 32))
    new = np.ones(len(e), bool)
    new[1:] = z[1:] + e[1:] * (1 << 32) > far[:-1]
    return list(zip(e[new].tolist(), a[new].tolist(), z[new].tolist()))


def _bytes(col: pa.Array) -> list[bytes]:
    return [x.as_buffer().to_pybytes() if x.is_valid else b"" for x in col]


def repeated_spans(docs: DataFrame, firsts: DataFrame, width: int = 20, hot: int = 1000, group: int = 60_000) -> DataFrame:
    """``(key, tie, lo, hi)``: word ranges of documents that repeat what starts earlier.

    ``docs(key long, tie long, text string, copy boolean)``: ``tie`` is a hash of the text, ``copy``
    true for a document whose whole text an earlier one has (those are left out here);
    ``firsts(key, tie)`` names the others. Prefixes are filed under the hash of the text.

    Suffixes (:func:`heads`) are grouped by variable-length prefixes: by ``PREFIXES[0]`` words; where
    more than ``hot`` share those, by ``PREFIXES[1]``; and where more than 16 times as many do, by
    all ``width`` words of a window. Prefixes that only one text has, once, can't head a repeat
    and go no further. Prefixes are dealt into tasks of about ``group`` entries, each of which
    builds the tree of its suffixes. Equal entries of one task before that meet there, so
    that a passage that a third of all documents share costs its tree one entry from each
    earlier task. Only texts that share a repeat and, by chance, all 64 bits of ``tie`` could miss it.
    """
    spark = docs.sparkSession

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ties = batch.column(0).to_numpy()
            out: list[list[np.ndarray]] = [[], [], []]
            for i in np.unique(ties, return_index=True)[1]:
                words = batch.column(1)[i].as_buffer().to_pybytes().split()
                if len(words) < width:
                    continue
                h, first, n = heads(words, width, PREFIXES[0])
                _, back, often = np.unique(h, return_inverse=True, return_counts=True)
                for col, x in zip(out, (h.view(np.int64), np.full(len(h), ties[i]), (first * 64 + n) * 2 + (often[back] > 1))):
                    col.append(x)
            if out[0]:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in out], ["h", "tie", "at"])

    filed = written(docs.select("tie", "text").mapInArrow(file, "h long, tie long, at long"), "heads")
    # as a table of its own, so that the join below has plain exchanges on both sides, which can be split
    shared = written(filed.groupBy("h").agg(
        F.count("*").alias("n"), F.min("tie").alias("t0"), F.max("tie").alias("t1"), F.max(F.col("at").bitwiseAND(F.lit(1))).alias("again")
    ).where("t0 <> t1 or again = 1").select("h", F.when(F.col("n") <= hot, 0).when(F.col("n") <= 16 * hot, 1).otherwise(2).alias("level")),
    "shared")
    ours = filed.join(shared, "h").select("tie", F.struct(F.shiftright("at", 1).alias("at"), "level", "h").alias("e"))
    lists = ours.groupBy("tie").agg(F.collect_set("e").alias("es")).join(firsts.select("key", "tie"), "tie")
    # lists are of firsts alone; "copy" comes along so that both uses of the texts share one exchange
    rows = docs.join(lists, ["key", "tie"]).select("key", "tie", "text", "es", "copy")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], list] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            out: list[list] = [[], [], [], [], [], []]
            for (_, text), (order, n, head, late) in seen.items():
                for col, x in zip(out, (head, *order, n, text)):
                    col.append(x)
                for o in late:  # these repeat an entry of this very task
                    for col, x in zip(out, (xxhash.xxh64_intdigest(repr(o)) - 2**63, *o, n, b"")):
                        col.append(x)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            return pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds)], ["p", "key", "tie", "start", "n", "words"])

        def note(level: int, text: bytes, order: tuple, n: int, head: int) -> None:
            nonlocal size
            old = seen.get((level, text))
            if old is None:
                seen[level, text] = [order, n, head, []]
                size += len(text) + 200
            else:
                late = max(order, old[0])
                old[0] = min(order, old[0])
                old[3].append(late)
                size += 60

        last = None
        for batch in batches:
            for key, tie, text, es in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _bytes(batch.column(2)),
                batch.column(3)):
                if (key, tie) == last:  # the row is there twice
                    continue
                last = key, tie
                words = text.split()
                e = es.values
                ats, levels, hs = (e.field(k).to_pylist() for k in ("at", "level", "h"))
                for at, level, h in zip(ats, levels, hs):
                    first, n = divmod(at, 64)
                    if first + n + width - 1 > len(words):  # of another text with the same hash
                        continue
                    span = words[first : first + n + width - 1]
                    if level == 0:
                        note(0, b" ".join(span), (key, tie, first), n, h)
                    elif level == 1:
                        for g, s, k in zip(*(x.tolist() for x in heads(span, width, PREFIXES[1]))):
                            note(1, b" ".join(span[s : s + k + width - 1]), (key, tie, first + s), k, g - 2**63)
                    else:
                        for s in range(n):
                            window = b" ".join(span[s : s + width])
                            note(2, window, (key, tie, first + s), 1, xxhash.xxh64_intdigest(window) - 2**63)
                if size > 24 << 20:
                    yield flush()
                    seen.clear()
                    size = 0
        if seen:
            yield flush()

    total = filed.count()
    tasks = max(partitions(spark), total // group + 1)
    entries = rows.mapInArrow(cut, "p long, key long, tie long, start long, n long, words binary").repartition(tasks, "p")

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, counts, order = [], [], []
        known: set[tuple] = set()
        for batch in batches:
            cols = [c.to_pylist() for c in batch.columns[1:5]]
            done: list[list[int]] = [[], [], [], []]
            for key, tie, start, n, words in zip(*cols, _bytes(batch.column(5))):
                if words and (key, tie, start, n) not in known:
                    known.add((key, tie, start, n))
                    texts.append(words)
                    counts.append(n)
                    order.append((key, tie, start))
                elif not words:
                    for col, x in zip(done, (key, tie, start, start + n - 1 + width)):
                        col.append(x)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in done], ["key", "tie", "lo", "hi"])
        if texts:
            found = [(*order[i][:2], order[i][2] + a, order[i][2] + z) for i, a, z in repeats(texts, counts, order, width)]
            yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*found) if found else ([], [], [], []))],
                ["key", "tie", "lo", "hi"])

    return entries.mapInArrow(grow, "key long, tie long, lo long, hi long")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 20, with_text: bool = False) -> DataFrame:
    """One row per document: ``(doc_id, n_words, n_removed, kept_sha256)``, and ``kept`` if asked for.

    Words ``[^\\x20\\x09-\\x0D]+``; a word goes if a window of ``width`` words over it also
    starts earlier: in a document with a smaller doc_id, or before it in its own. Windows are
    judged on the input. A null text has no words. A null doc_id comes after all others;
    different texts under one doc_id are documents of their own, ordered by a hash of the
    text; rows equal in doc_id and text are one document, and each gets its result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.coalesce("id", F.lit(_LAST)).alias("key"), F.xxhash64("text").alias("tie"), "text")
    # equal texts: the first stays, the others are repeats as a whole
    named = written(rows.select("key", "tie", F.sha2("text", 256).alias("sha")), "named")
    groups = written(named.groupBy("sha").agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1"), "groups")
    copies = meet(named, groups, "sha", F.xxhash64("key")).where("key > first")
    copies = written(copies.select("key", "tie", F.lit(True).alias("is_copy")).distinct(), "copies")
    firsts = named.select("key", "tie").distinct().join(copies, ["key", "tie"], "left_anti")
    marked = rows.join(copies, ["key", "tie"], "left").select("key", "tie", "text", F.col("is_copy").isNotNull().alias("copy"))
    # one plan from here on: the texts are dealt out once, for cutting and for the result
    spans = repeated_spans(marked, firsts, width)
    ranges = spans.groupBy("key", "tie").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    joined = marked.join(ranges, ["key", "tie"], "left").select("key", "text", "copy", "ranges")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for key, text, copy, ranges in zip(batch.column(0).to_pylist(), _bytes(batch.column(1)), batch.column(2).to_pylist(),
                batch.column(3)):
                words = text.split()
                kept = words
                if copy:
                    kept = words if len(words) < width else []
                elif ranges.is_valid:
                    delta = np.zeros(len(words) + 1, np.int64)
                    np.add.at(delta, ranges.values.field("lo").to_numpy(), 1)
                    np.add.at(delta, ranges.values.field("hi").to_numpy(), -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(delta[:-1]) == 0).tolist()]
                line = b" ".join(kept)
                for col, x in zip(out, (None if key == _LAST else key, len(words), len(words) - len(kept), hashlib.sha256(line).hexdigest(),
                    line.decode() if with_text else None)):
                    col.append(x)
            arrays = [pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()))]
            yield pa.record_batch(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    done = joined.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string")
    return done if with_text else done.drop("kept")
