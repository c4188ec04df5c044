"""Masked pseudo-likelihood: a bidirectional window network scores documents."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, written

SPAN = 2  # words on each side
DIM, HIDDEN = 8, 16
#: Words of each class, the commonest first: classes of common words are narrow, so that most tokens cost little.
WIDTHS = (8,) * 4 + (16,) * 4 + (32,) * 4 + (64,) * 4 + (128,) * 8 + (256,) * 10
#: Ids: 0 for every word outside the vocabulary (a class of its own), then the vocabulary by frequency, then the edge of a text.
IDS = 1 + sum(WIDTHS)
RARE, PAD = 0, IDS
STARTS = np.concatenate([[0, 1], 1 + np.cumsum(WIDTHS)])
CLASSES = len(STARTS) - 1
CLASS_OF = np.repeat(np.arange(CLASSES, dtype=np.uint8), np.diff(STARTS))
#: Weights by name; the last of the hidden units is always 1, so that ``a`` and ``u`` end in biases.
SHAPES = {"e": (IDS + 1, DIM), "w": (2 * SPAN * DIM, HIDDEN), "b": (HIDDEN,), "a": (CLASSES, HIDDEN + 1), "u": (IDS, HIDDEN + 1)}


def _softmax(z: np.ndarray) -> np.ndarray:
    """Softmax down the columns, in place."""
    z -= z.max(axis=0)
    np.exp(z, out=z)
    z /= z.sum(axis=0)
    return z


@dataclass
class Net:
    """A window network whose softmax has two levels: a class of words, then the word in it.

    Rows of a batch are columns here, and sorted by class, so that each class is one slice.
    """

    p: dict[str, np.ndarray]

    @classmethod
    def start(cls, counts: np.ndarray, seed: int = 0) -> Net:
        """Small random weights; the output biases are the corpus's log frequencies."""
        rng = np.random.default_rng(seed)
        p = {k: (rng.standard_normal(s) * 0.1).astype(np.float32) for k, s in SHAPES.items()}
        freq = counts + 1.0
        of = np.add.reduceat(freq, STARTS[:-1])
        p["a"][:, -1] = np.log(of / of.sum())
        p["u"][:, -1] = np.log(freq / of[CLASS_OF])
        p["b"][:] = 0
        p["e"][PAD] = 0
        return cls(p)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in SHAPES])

    @classmethod
    def of(cls, flat: np.ndarray) -> Net:
        p, at = {}, 0
        for k, s in SHAPES.items():
            n = math.prod(s)
            p[k] = flat[at : at + n].reshape(s).astype(np.float32)
            at += n
        return cls(p)

    def _hidden(self, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.take(self.p["e"], context, axis=0).reshape(len(context), -1)
        h = np.ones((HIDDEN + 1, len(x)), np.float32)
        np.matmul(self.p["w"].T, x.T, out=h[:-1])
        h[:-1] += self.p["b"][:, None]
        np.tanh(h[:-1], out=h[:-1])
        return x, h

    @staticmethod
    def _by_class(target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, int, int, int]]]:
        """The batch's order by class, classes and words in that order, and the slices of classes with a choice of words."""
        of = CLASS_OF[target]
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=CLASSES)).tolist()
        slices = [(int(STARTS[c]), int(STARTS[c + 1]), ends[c - 1], ends[c]) for c in range(1, CLASSES) if ends[c] > ends[c - 1]]
        return order, of[order].astype(np.int64), target[order], slices

    def log_probs(self, context: np.ndarray, target: np.ndarray, batch: int = 8192) -> np.ndarray:
        """Log-probability of each target from the words on both of its sides."""
        out = np.empty(len(target))
        for at in range(0, len(target), batch):
            order, of, word, slices = self._by_class(target[at : at + batch])
            _, h = self._hidden(context[at : at + batch][order])
            n = np.arange(len(order))
            got = np.log(_softmax(self.p["a"] @ h)[of, n]).astype(float)
            for a, z, lo, hi in slices:
                got[lo:hi] += np.log(_softmax(self.p["u"][a:z] @ h[:, lo:hi])[word[lo:hi] - a, n[: hi - lo]])
            out[at + order] = got
        return out

    def step(self, context: np.ndarray, target: np.ndarray, memory: dict[str, np.ndarray], rate: float) -> None:
        """One Adagrad step on a batch; ``memory`` holds the squared gradients so far."""
        order, of, word, slices = self._by_class(target)
        context = context[order]
        n = np.arange(len(order))
        x, h = self._hidden(context)
        miss = _softmax(self.p["a"] @ h)
        miss[of, n] -= 1
        grads = {"a": miss @ h.T, "u": np.zeros_like(self.p["u"])}
        dh = self.p["a"].T @ miss
        for a, z, lo, hi in slices:
            miss = _softmax(self.p["u"][a:z] @ h[:, lo:hi])
            miss[word[lo:hi] - a, n[: hi - lo]] -= 1
            grads["u"][a:z] = miss @ h[:, lo:hi].T
            dh[:, lo:hi] += self.p["u"][a:z].T @ miss
        dh, h = dh[:-1], h[:-1]
        dh *= 1 - h * h
        grads["w"], grads["b"] = x.T @ dh.T, dh.sum(axis=1)
        dx = (self.p["w"] @ dh).reshape(2 * SPAN, DIM, -1)
        flat = context.T.ravel()
        grads["e"] = np.stack([np.bincount(flat, dx[:, k].ravel(), IDS + 1) for k in range(DIM)], axis=1).astype(np.float32)
        grads["e"][PAD] = 0
        for k, g in grads.items():
            g /= len(order)
            memory[k] += g * g
            self.p[k] -= rate * g / (np.sqrt(memory[k]) + 1e-6)


class Trainer:
    """One task's copy of the network, and the tokens that don't fill a batch yet."""

    def __init__(self, flat: np.ndarray, batch: int, rate: float) -> None:
        self.net, self.batch, self.rate = Net.of(flat), batch, rate
        self.memory = {k: np.full(s, 1e-3, np.float32) for k, s in SHAPES.items()}
        self.context, self.target = np.empty((0, 2 * SPAN), np.int64), np.empty(0, np.int64)
        self.seen = 0

    def feed(self, context: np.ndarray, target: np.ndarray) -> None:
        context, target = np.concatenate([self.context, context]), np.concatenate([self.target, target])
        cut = len(target) - len(target) % self.batch
        for z in range(0, cut, self.batch):
            self.net.step(context[z : z + self.batch], target[z : z + self.batch], self.memory, self.rate)
        self.seen += cut
        self.context, self.target = context[cut:].copy(), target[cut:].copy()

    def finish(self) -> tuple[np.ndarray, int]:
        if len(self.target):
            self.net.step(self.context, self.target, self.memory, self.rate)
            self.seen += len(self.target)
        return self.net.flat(), self.seen


@dataclass
class Words:
    """What the corpus's word counts tell: ids and log shares of the listed words, and the rest as a table.

    A listed word is in ``index``; below ``IDS - 1`` the index gives its id, less one; beyond, it is
    ``RARE``. ``shares`` is the log of its share of all rare tokens, 0 for a word with an id of its own.
    ``freq`` counts the tokens of each id. ``counts(w, n)`` holds every word, listed or not, and stays
    distributed.
    """

    index: dict[bytes, int]
    ids: np.ndarray
    shares: np.ndarray
    freq: np.ndarray
    counts: DataFrame


def word_counts(docs: DataFrame, text_col: str = "text", listed: int = 131_072) -> Words:
    """Count every word of all texts; list those as common as the ``listed``-th.

    The driver sees a histogram of counts and the words at or above a count that at most
    ``listed`` words reach. The ``IDS - 1`` commonest of those get an id of their own.
    """
    words = docs.select(F.explode_outer(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(WORD),
        F.lit(0))).alias("w")).where("w is not null")
    counts = written(words.groupBy("w").agg(F.count("*").alias("n")), "words")
    # counts beyond 4,096 by sixteenths of a doubling: a histogram of some thousand rows at every size
    level = F.when(F.col("n") <= 4096, F.col("n")).otherwise(4096 + F.floor((F.log2("n") - 12) * 16)).cast("long")
    levels = counts.groupBy(level.alias("k")).agg(F.count("*").alias("words"), F.min("n").alias("least"),
        F.sum("n").alias("tokens")).collect()
    cut, many = None, 0
    for r in sorted(levels, key=lambda r: -r["k"]):
        many += r["words"]
        if many > listed:
            break
        cut = r["least"]
    top = [] if cut is None else sorted((-r["n"], r["w"].encode()) for r in counts.where(F.col("n") >= cut).collect())
    own = top[: IDS - 1]
    freq = np.zeros(IDS)
    freq[1 : 1 + len(own)] = [-n for n, _ in own]
    freq[RARE] = sum(r["tokens"] for r in levels) - freq.sum()
    ids, shares = np.zeros(len(top), np.int64), np.zeros(len(top))
    ids[: len(own)] = np.arange(1, 1 + len(own))
    shares[len(own) :] = [math.log(-n / freq[RARE]) for n, _ in top[len(own) :]]
    return Words({w: i for i, (_, w) in enumerate(top)}, ids, shares, freq, counts)


def windows(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Contexts and targets of all tokens of some documents, in order; no window crosses two documents."""
    pad = np.full(SPAN, PAD, np.int64)
    line = np.concatenate([pad, *[x for d in docs for x in (d, pad)]])
    n = len(line) - 2 * SPAN
    inner = np.flatnonzero(line[SPAN : SPAN + n] != PAD)
    return np.stack([line[inner + k] for k in range(2 * SPAN + 1) if k != SPAN], axis=1), line[inner + SPAN]


def _chunks(sizes: list[int], most: int = 65_536) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``most`` tokens."""
    lo = total = 0
    for i, n in enumerate(sizes):
        total += n
        if total >= most:
            yield lo, i + 1
            lo, total = i + 1, 0
    if total:
        yield lo, len(sizes)


#: What a training round writes: a row per document, and one per block of a task's weights.
ROUND = "n long, ids binary, fixed double, tail array<binary>, task int, block int, weight double, part binary"


def _weights(trainer: Trainer, blocks: int, kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    out, seen = trainer.finish()
    if seen:
        cuts = np.linspace(0, len(out), blocks + 1).astype(int)
        none = [pa.nulls(blocks, k) for k in (pa.int64(), kind, pa.int64(), pa.binary(), pa.float64(), pa.list_(pa.binary()))]
        task = TaskContext.get()
        yield pa.record_batch([
            *none, pa.array([task.partitionId() if task else 0] * blocks, pa.int32()), pa.array(range(blocks), pa.int32()),
            pa.array([float(seen)] * blocks),
            pa.array([out[a:z].tobytes() for a, z in zip(cuts[:-1], cuts[1:])], pa.binary())],
            ["row", "doc_id", "n", "ids", "fixed", "tail", "task", "block", "weight", "part"])


def average(parts: DataFrame, fan: int = 64) -> np.ndarray | None:
    """The mean of all tasks' weights by their tokens, summed ``fan`` tasks at a time, block by block.

    The driver gets one sum for each block; None if no task saw a token.
    """
    def total(key: tuple, t: pa.Table) -> pa.Table:
        acc, weight = 0.0, 0.0
        for w, part in zip(t["weight"].to_pylist(), t["part"]):
            acc = acc + w * np.frombuffer(part.as_buffer(), np.float32).astype(np.float64)
            weight += w
        return pa.table({"task": pa.array([key[1].as_py()], pa.int32()), "block": pa.array([key[0].as_py()], pa.int32()),
                         "weight": pa.array([weight]), "part": pa.array([(acc / weight).astype(np.float32).tobytes()], pa.binary())})

    last = parts.agg(F.max("task")).first()[0]
    if last is None:
        return None
    while True:
        parts = parts.withColumn("task", F.expr(f"task div {fan}").cast("int")).groupBy("block", "task").applyInArrow(
            total, "task int, block int, weight double, part binary")
        last //= fan
        if not last:
            break
    return np.concatenate([np.frombuffer(r["part"], np.float32) for r in sorted(parts.collect(), key=lambda r: r["block"])])


def train(docs: DataFrame, words: Words, text_col: str = "text", id_col: str = "doc_id", rounds: int = 1, rate: float = 0.2,
    batch: int = 4096, blocks: int = 64) -> tuple[Net, DataFrame]:
    """The network, and the documents as ``(row, doc_id, n, ids, fixed, tail)``, a table in the shared folder.

    Parameter averaging: in a round each task trains a copy on every token of its documents, and
    the copies are averaged by their tokens. The first round also writes each text as ids, for
    later rounds and for scoring, with ``fixed``, the log shares of its listed words, and ``tail``,
    its words that are not listed.
    """
    net = Net.start(words.freq)
    index, shares = words.index, words.shares
    known = np.append(words.ids, RARE)  # the last is for words that are not listed
    kind = docs.schema[id_col].dataType.simpleString()

    def first(flat: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, get, none = Trainer(flat, batch, rate), index.get, pa.null()
            for b in batches:
                none = b.column(1).type
                ids, fixed, tails = [], [], []
                for t in b.column(2):
                    bare = t.as_buffer().to_pybytes().split() if t.is_valid else []
                    at = np.fromiter(map(get, bare, repeat(-1)), np.int64, len(bare))
                    tail = [bare[i] for i in np.flatnonzero(at < 0).tolist()]
                    fixed.append(float(shares[at[at >= 0]].sum()))
                    ids.append(known[at])
                    tails.append(tail)
                sizes = [len(x) for x in ids]
                for lo, hi in _chunks(sizes):
                    trainer.feed(*windows(ids[lo:hi]))
                n = len(ids)
                yield pa.record_batch(
                    [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array([x.astype("<u2").tobytes() for x in ids], pa.binary()),
                    pa.array(fixed, pa.float64()),
                     pa.array(tails, pa.list_(pa.binary())), pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.float64()),
                     pa.nulls(n, pa.binary())],
                    ["row", "doc_id", "n", "ids", "fixed", "tail", "task", "block", "weight", "part"])
            yield from _weights(trainer, blocks, none)
        return run

    def later(flat: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer = Trainer(flat, batch, rate)
            for b in batches:
                ids = [np.frombuffer(x.as_buffer(), "<u2").astype(np.int64) for x in b.column(0)]
                for lo, hi in _chunks([len(x) for x in ids]):
                    trainer.feed(*windows(ids[lo:hi]))
            for out in _weights(trainer, blocks, pa.int64()):
                yield out.select(["task", "block", "weight", "part"])
        return run

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
        F.col(text_col).cast("string").alias("text"))
    table = written(rows.mapInArrow(first(net.flat()), f"row long, doc_id {kind}, {ROUND}"), "ids")
    coded = table.where("block is null").select("row", "doc_id", "n", "ids", "fixed", "tail")
    parts = table.where("block is not null").select("task", "block", "weight", "part")
    for r in range(rounds):
        if r:
            parts = coded.select("ids").mapInArrow(later(net.flat()), "task int, block int, weight double, part binary")
        flat = average(parts)
        if flat is None:
            break
        net = Net.of(flat)
    return net, coded


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = 1, listed: int = 131_072) -> DataFrame:
    """One row per document: ``(doc_id, n_tokens, pll, mean_pll)``.

    ``pll`` sums, over the whole text, each token's log-probability given the ``SPAN`` tokens on
    either side; ``mean_pll`` is that by token. Every word of all documents is counted, and the
    network is trained on every token of every document in each of ``rounds``: it predicts one
    of the ``IDS - 1`` commonest words or that a word is rare, and a rare word then has its share
    of all rare tokens that were counted, so that the probabilities of all counted words sum to 1.
    As context, rare words are alike. The counts of the ``listed``
    commonest words go to the tasks; those of the others, which grow with the corpus, stay a table
    that such tokens meet in a join. A null or empty text has no tokens, a sum of 0 and a null
    mean; repeated rows repeat; an empty table gives an empty result. Other columns are not read.
    """
    words = word_counts(docs, text_col, listed)
    net, coded = train(docs, words, text_col, id_col, rounds)
    kind = docs.schema[id_col].dataType.simpleString()
    flat = net.flat()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine = Net.of(flat)
        for b in batches:
            ids = [np.frombuffer(x.as_buffer(), "<u2").astype(np.int64) for x in b.column(3)]
            sizes = np.array([len(x) for x in ids])
            sums = np.zeros(len(ids))
            for lo, hi in _chunks(sizes.tolist()):
                got = np.concatenate([[0.0], np.cumsum(mine.log_probs(*windows(ids[lo:hi])))])
                ends = np.cumsum(sizes[lo:hi])
                sums[lo:hi] = got[ends] - got[ends - sizes[lo:hi]]
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(sums + b.column(4).to_numpy(zero_copy_only=False))],
                ["row", "doc_id", "n_tokens", "known"])

    scored = coded.select("row", "doc_id", "n", "ids", "fixed").mapInArrow(run, f"row long, doc_id {kind}, n_tokens long, known double")
    # words that are not listed: each with its share of the rare tokens
    share = F.ln(F.col("n") / F.lit(float(words.freq[RARE])))
    rare = coded.select("row", F.explode("tail").alias("w")).select("row", F.col("w").cast("string").alias("w"))
    added = rare.join(words.counts, "w").groupBy("row").agg(F.sum(share).alias("share"))
    pll = F.col("known") + F.coalesce("share", F.lit(0.0))
    return scored.join(added, "row", "left").select("doc_id", "n_tokens", pll.alias("pll"),
        F.when(F.col("n_tokens") > 0, pll / F.col("n_tokens")).alias("mean_pll"))
