"""SimHash near-duplicates: fingerprints, a binary trie self-join, and components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, meet, written

BITS = 64
_ONE = np.uint64(1)


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """SimHash of one text: a bit is 1 if set in over half of the shingles' XXH64."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = ends[: len(words) - shingle + 1] - np.fromiter(map(len, words), np.int64, len(words))[: len(words) - shingle + 1] - 1
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts.tolist(), stops)), np.uint64, len(stops))
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp long)``: the 64 bits of each whole text's fingerprint, as a signed long.

    Lower-cases A-Z; words are ``[^\\x20\\x09-\\x0D]+``. A null or empty text has fingerprint 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle, seed) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(np.array(fps, np.uint64).view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    cols = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return cols.mapInArrow(run, f"doc_id {kind}, fp long")


def trie_pairs(a: np.ndarray, b: np.ndarray | None, depth: int, budget: int, small: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of indices ``(i, j)`` with ``popcount(a[i] ^ b[j]) <= budget``, by a binary trie join.

    ``a`` and ``b`` are sorted unsigned arrays, each with one common prefix of ``depth`` bits;
    ``b`` None joins ``a`` with itself (``i < j``). A trie node is a range of a sorted array.
    Pairs of nodes go down together, one bit at a time; each carries the bits by which its
    prefixes differ and is dropped when they exceed ``budget``. A pair of nodes with at most
    ``small`` pairs of keys is compared outright.
    """
    own = b is None
    b = a if own else b
    if not len(a) or not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    err = 0 if own or not depth else int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(BITS - depth)))
    front = np.array([[0], [len(a)], [0], [len(b)], [err]], np.int64)
    if err > budget:
        front = front[:, :0]
    left, right = [], []
    while front.size:
        n = (front[1] - front[0]) * (front[3] - front[2])
        done = (n <= small) | (depth >= BITS)
        if done.any():
            end = front[:, done]
            n = (end[1] - end[0]) * (end[3] - end[2])
            for lo in range(0, len(n), 1 << 16):
                e, m = end[:, lo : lo + (1 << 16)], n[lo : lo + (1 << 16)]
                which = np.repeat(np.arange(len(m)), m)
                at = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
                wide = (e[3] - e[2])[which]
                i, j = e[0][which] + at // wide, e[2][which] + at % wide
                if own:
                    keep = i < j
                    i, j = i[keep], j[keep]
                ok = np.bitwise_count(a[i] ^ b[j]) <= budget
                left.append(i[ok])
                right.append(j[ok])
            front = front[:, ~done]
        if not front.size:
            break
        bit = np.uint64(BITS - 1 - depth)
        over = ~((_ONE << bit) - _ONE)

        def cut(keys: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
            mid = (keys[lo] & over) | (_ONE << bit)
            return np.clip(np.searchsorted(keys, mid), lo, hi)

        ma, mb = cut(a, front[0], front[1]), cut(b, front[2], front[3])
        nexts = []
        for x in (0, 1):
            for y in (0, 1):
                lo_a, hi_a = (front[0], ma) if x == 0 else (ma, front[1])
                lo_b, hi_b = (front[2], mb) if y == 0 else (mb, front[3])
                keep = (lo_a < hi_a) & (lo_b < hi_b) & (front[4] + (x != y) <= budget)
                if own:
                    keep &= lo_a <= lo_b
                nexts.append(np.stack([lo_a, hi_a, lo_b, hi_b, front[4] + (x != y)])[:, keep])
        front = np.concatenate(nexts, axis=1)
        depth += 1
    empty = [np.empty(0, np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def forest(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A star per component of the graph on ``range(n)``: ``(node, least node)`` of each linked node."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        while (hop := new[new]).tolist() != new.tolist():
            new = hop
        if (new == label).all():
            break
        label = new
        keep = label[i] != label[j]
        i, j = i[keep], j[keep]
    node = np.flatnonzero(label != np.arange(n))
    return node, label[node]


def _prefix(fp: Column, depth: int) -> Column:
    """The leading ``depth`` bits as a number."""
    return F.shiftrightunsigned(fp, BITS - depth) if depth else F.lit(0).cast("long")


def _cover(keys: DataFrame, leaf: int, n: int, step: int = 8) -> DataFrame:
    """The trie's leaves as ``(depth int, prefix long, fps array<long>)``, of at most ``leaf`` keys each.

    Keys are counted below the prefixes that would hold half a leaf each if keys were spread
    evenly; keys below prefixes that hold more go ``step`` bits deeper, until none is left.
    Distinct keys part by 64 bits. All of this stays a table: the driver sees how many go on.
    """
    depth = min(BITS, max(0, math.ceil(math.log2(max(1, n / leaf))) + 1))
    rest, done = keys, []
    while True:
        named = rest.select("fp", F.hex(_prefix(F.col("fp"), depth)).alias("node"))
        counted = meet(named, written(named.groupBy("node").agg(F.count("*").alias("n")), "nodes"), "node", F.xxhash64("fp"))
        small = (F.col("n") <= leaf) if depth < BITS else F.lit(True)
        level = written(counted.select("fp", F.lit(depth).alias("depth"), small.alias("fits")), "keys")
        done.append(level.where("fits").select("depth", _prefix(F.col("fp"), depth).alias("prefix"), "fp"))
        rest = level.where("not fits").select("fp")
        if depth >= BITS or rest.isEmpty():
            break
        depth = min(BITS, depth + step)
    return reduce(DataFrame.unionByName, done).groupBy("depth", "prefix").agg(F.collect_list("fp").alias("fps"))


def _leaf_pairs(leaves: DataFrame, budget: int) -> DataFrame:
    """``(da, pa, db, pb)``: pairs of leaves whose prefixes differ by at most ``budget`` bits in what both have.

    A leaf meets the leaves as deep as it or deeper in an equi-join: it has one row for each
    set of at most ``budget`` bits flipped, they have one for each depth above them.
    """
    depths = sorted(r[0] for r in leaves.select("depth").distinct().collect())  # at most BITS + 1
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    masks = [(d, signed(sum(1 << b for b in bits))) for d in depths for k in range(budget + 1) for bits in combinations(range(d), k)]
    flips = F.broadcast(leaves.sparkSession.createDataFrame(masks, "da int, mask long"))  # its size depends on budget and BITS alone
    names = leaves.select("depth", "prefix")
    near = names.select(F.col("depth").alias("da"), F.col("prefix").alias("pa")).join(flips, "da").select("da", "pa",
        F.col("pa").bitwiseXOR(F.col("mask")).alias("q"))
    above = F.filter(F.array(*[F.lit(d) for d in depths]), lambda d: d <= F.col("depth"))
    deep = names.select(F.col("depth").alias("db"), F.col("prefix").alias("pb"), F.explode(above).alias("k")).select(
        "db", "pb", F.col("k").alias("da"), F.expr("if(k = 0, 0L, shiftrightunsigned(pb, db - k))").alias("q"))
    return near.join(deep, ["da", "q"]).where("da < db or pa <= pb").select("da", "pa", "db", "pb")


def near_links(keys: DataFrame, budget: int = 2, leaf: int | None = None, per_task: int = 128) -> DataFrame:
    """Links among distinct fingerprints, as forests: ``keys(fp long)`` to ``(u long, v long)``.

    Every pair of fingerprints within ``budget`` bits ends up connected; of the links that
    one pair of trie nodes finds, only a spanning star per component leaves its task, so that
    thousands of near copies give thousands of rows and not millions. A task joins about
    ``per_task`` pairs of leaves at every size of the input: tasks grow in number, not in memory.
    """
    spark = keys.sparkSession
    n = keys.count()
    if not n:
        return spark.createDataFrame([], "u long, v long")
    leaves = written(_cover(keys, leaf or int(min(16384, max(128, n / 256))), n), "leaves")
    pairs = written(_leaf_pairs(leaves, budget), "pairs")
    whole = pairs.join(leaves.select(F.col("depth").alias("da"), F.col("prefix").alias("pa"), F.col("fps").alias("x")), ["da", "pa"])
    whole = whole.join(leaves.select(F.col("depth").alias("db"), F.col("prefix").alias("pb"), F.col("fps").alias("y")), ["db", "pb"])
    own = (F.col("da") == F.col("db")) & (F.col("pa") == F.col("pb"))

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for depth, same, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                a = np.sort(x.values.to_numpy().view(np.uint64))
                if same:
                    keys_, (left, right) = a, trie_pairs(a, None, depth, budget)
                else:
                    b = np.sort(y.values.to_numpy().view(np.uint64))
                    left, right = trie_pairs(a, b, depth, budget)
                    keys_, right = np.concatenate([a, b]), right + len(a)
                node, root = forest(len(keys_), left, right)
                us.append(keys_[node].view(np.int64))
                vs.append(keys_[root].view(np.int64))
            yield pa.record_batch([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])

    dealt = whole.select(F.col("da").alias("depth"), own.alias("same"), "x", "y").repartition(pairs.count() // per_task + 2)
    return dealt.mapInArrow(join, "u long, v long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, seed: int = 42,
    budget: int = 2) -> DataFrame:
    """One row per document: ``(doc_id, fingerprint string, component_id)``.

    Fingerprints within ``budget`` bits are linked, and so are equal ones; ``component_id`` is
    the smallest doc_id reachable. Only distinct fingerprints are joined, each under its
    smallest doc_id. A null doc_id gets its fingerprint and the component that its
    fingerprint reaches (null if no other document is there). Repeated rows repeat. An
    empty table gives an empty result.
    """
    fps = written(fingerprints(docs, id_col, text_col, shingle, seed), "fingerprints")
    least = written(fps.groupBy("fp").agg(F.min("doc_id").alias("first")), "least")
    found = written(near_links(least.select("fp"), budget), "links")
    # components over fingerprints first; the smallest doc_id of each component afterwards
    comp = components(found)
    joined = least.join(comp, least.fp == comp.node, "left").select("fp", "first", F.coalesce("component", "fp").alias("c"))
    lowest = joined.groupBy("c").agg(F.min("first").alias("component_id"))
    classes = joined.join(lowest, "c").select("fp", "component_id")
    out = fps.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
    return out
