"""Toxicity by compression distance: zstandard dictionaries of toxic and of ordinary text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import written

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_OTHER = re.compile(rb"[^a-z\x80-\xff]+")


def plain(text: bytes) -> bytes:
    """Lower-case letters and single spaces: what is compressed."""
    return _OTHER.sub(b" ", text.translate(_FOLD)).strip()


def windows(line: bytes, size: int) -> list[bytes]:
    """The whole line in pieces of whole words, of ``size`` bytes or one word more."""
    out, at, n = [], 0, len(line)
    while at < n:
        end = line.find(b" ", min(n, at + size))
        end = n if end < 0 else end
        out.append(b" " + line[at:end] + b" ")
        at = end + 1
    return out


def _stems(line: bytes, short: int, long: int) -> set[bytes]:
    out = set()
    for w in set(line.split()):
        out.add(w)
        for k in range(short, min(long, len(w))):
            out.add(w[:k])
    return out


def unlike(lines: list[bytes], near: float = 0.8) -> list[bytes]:
    """The lines without near copies: a line goes if the word Jaccard similarity to a kept one is at least ``near``.

    Candidates share one of their rarest words, of which two sets that alike must share one;
    each is compared whole.
    """
    sets = [set(line.split()) for line in lines]
    freq = Counter(w for s in sets for w in s)
    kept: list[int] = []
    filed: dict[bytes, list[int]] = {}
    bare = False
    for i, s in enumerate(sets):
        # one word more than the bound asks for, against rounding
        head = sorted(s, key=lambda w: (freq[w], w))[: len(s) - math.ceil(near * len(s)) + 2]
        rivals = {j for w in head for j in filed.get(w, ())}
        if any(len(s & sets[j]) >= near * len(s | sets[j]) for j in rivals) or (not s and bare):
            continue
        bare = bare or not s
        kept.append(i)
        for w in head:
            filed.setdefault(w, []).append(i)
    return [lines[i] for i in kept]


def marked(ours: list[bytes], theirs: list[bytes], least: float = 0.015, lift: float = 6.0, short: int = 4, long: int = 9) -> set[bytes]:
    """Words and word beginnings that at least a share ``least`` of ``ours`` has and that are
    ``lift`` times as common there as in ``theirs``."""
    n, m = max(1, len(ours)), max(1, len(theirs))
    floor = max(2, least * n)
    # counted by hash first, so that the driver keeps names of those alone that may be common enough
    cells = np.zeros(1 << 20, np.int32)
    for line in ours:
        cells[[xxhash.xxh32_intdigest(w) & 0xFFFFF for w in _stems(line, short, long)]] += 1
    a: Counter = Counter()
    for line in ours:
        a.update(w for w in _stems(line, short, long) if cells[xxhash.xxh32_intdigest(w) & 0xFFFFF] >= floor)
    a = Counter({w: k for w, k in a.items() if k >= floor})
    b: Counter = Counter()
    for line in theirs:
        b.update(w for w in _stems(line, short, long) if w in a)
    return {w for w, k in a.items() if k / n > lift * (b[w] + 0.5) / m}


def parted(line: bytes, stems: set[bytes], short: int = 4) -> tuple[bytes, bytes]:
    """The beginnings in a text that are among ``stems``, and the text without the words that have them."""
    own, rest = [], []
    for w in line.split():
        for k in range(len(w), min(short, len(w)) - 1, -1):
            if w[:k] in stems:
                own.append(w[:k])
                break
        else:
            rest.append(w)
    return b" ".join([b"", *own, b""]) if own else b"", b" ".join(rest)


def _train(samples: list[bytes], size: int) -> bytes:
    """The text of a zstandard dictionary trained on ``samples``; what there is, if too little to train on."""
    samples = [s for s in samples if s]
    try:
        trained = zstandard.train_dictionary(size, samples, k=48, d=6).as_bytes()
    except zstandard.ZstdError:
        return b"".join(dict.fromkeys(samples))[-size:]
    text = re.search(rb"[a-z\x80-\xff ]*$", trained).group(0)  # without header and entropy tables
    return text or trained[-size:]


#: Bytes saved that count as a hit, from a slight one on.
STEPS = (2, 3, 4, 5, 6, 8)
FEATURES = 5 + len(STEPS)


def measures(gains: np.ndarray) -> np.ndarray:
    """Features of a document from the bytes that the toxic dictionary saves in each window: the three most, how many
    windows save so many (by the root of their number), the mean, and how many windows there are."""
    n = len(gains)
    if not n:
        return np.zeros(FEATURES)
    top = np.zeros(3)
    top[: min(3, n)] = np.sort(gains)[::-1][:3]
    return np.array([*top, *((gains >= k).sum() / math.sqrt(n) for k in STEPS), gains.mean(), math.log1p(n)], float)


#: How matches are sought: every place of a dictionary has its slot, and a match has at least six bytes, about a word;
#: shorter ones are chance.
SEARCH = {"window_log": 17, "chain_log": 17, "hash_log": 17, "search_log": 4, "min_match": 6, "target_length": 0,
    "strategy": zstandard.STRATEGY_FAST}


@dataclass
class Model:
    common: bytes
    toxic: bytes
    ordinary: bytes
    size: int
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def presses(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        out = []
        for tail in (self.toxic, self.ordinary):
            known = zstandard.ZstdCompressionDict(self.common + tail, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            how = zstandard.ZstdCompressionParameters(**SEARCH, write_content_size=False, write_dict_id=False, write_checksum=False)
            known.precompute_compress(compression_params=how)
            out.append(zstandard.ZstdCompressor(dict_data=known, compression_params=how))
        return out[0], out[1]

    def gains(self, text: bytes, presses: tuple) -> np.ndarray:
        toxic, ordinary = presses[0].compress, presses[1].compress
        return np.array([len(ordinary(w)) - len(toxic(w)) for w in windows(plain(text), self.size)], np.int64)

    def score(self, features: np.ndarray) -> np.ndarray:
        z = ((features - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: list[bytes], labels: list[int], share: float | None = None, size: int = 40, common_bytes: int = 16384,
    tail_bytes: int = 1024, least: float = 0.015, lift: float = 6.0, near: float = 0.8) -> Model:
    """Dictionaries and thresholds from labelled texts.

    Both dictionaries begin with the same text trained on the ordinary class, whole texts but for the
    words that mark toxic ones off; the toxic one ends in a dictionary trained on those parts of the
    toxic texts, the ordinary one in as much more ordinary text. (Dictionaries trained on the classes'
    whole texts alone differ by chance in the prose they hold, which outweighs what is toxic in a
    window.) Of near copies (:func:`unlike`) one is used, all other texts whole. A logistic model of
    the window gains sets the thresholds, for classes as common as ``share`` of toxic texts says
    (None: as in ``texts``).
    """
    lines = [plain(t) for t in texts]
    y = np.array(labels)
    if not len(y) or y.min() == y.max():
        base = float(y.mean()) if len(y) else 0.0
        w = np.zeros(FEATURES + 1)
        w[0] = math.log((base + 1e-3) / (1 - base + 1e-3))
        return Model(b"", b" ", b" ", size, np.zeros(FEATURES), np.ones(FEATURES), w)
    tox = [x for x, k in zip(lines, labels) if k]
    ord_ = [x for x, k in zip(lines, labels) if not k]
    tox, ord_ = unlike(tox, near), unlike(ord_, near)
    stems = marked(tox, ord_, least, lift)
    # what marks toxic text off is kept out of the part that both share, even where a label is wrong
    prose = [parted(x, stems)[1] for x in ord_]
    common = _train([x[i : i + 512] for x in prose for i in range(0, len(x), 512)], common_bytes)[-common_bytes:]
    toxic = _train([parted(x, stems)[0] for x in tox], tail_bytes)
    ordinary = common[: len(toxic)]
    model = Model(common, toxic or b" ", (ordinary or b" ")[: max(1, len(toxic))], size, np.zeros(FEATURES), np.ones(FEATURES),
        np.zeros(FEATURES + 1))
    presses = model.presses()
    x = np.stack([measures(model.gains(t, presses)) for t in texts])
    model.mean, model.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    z = np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale])
    w = np.zeros(FEATURES + 1)
    for _ in range(60):  # Newton's method with a small ridge
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(h, z.T @ (y - p) - 1e-2 * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    if share is not None and 0 < share < 1:
        w[0] += math.log(share / (1 - share)) - math.log(y.mean() / (1 - y.mean()))
    model.weights = w
    return model


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = 2500,
                    class_bytes: int = 48 << 20) -> tuple[list[bytes], list[int], float | None]:
    """Texts, labels, and the share of toxic ones among all labels that are not held out.

    At most ``per_class`` labelled texts of each class and ``class_bytes`` of them, none held out, in the order of the hash
    of their id. Ids that are labelled both ways are not used; of several texts under one id one is. Ids are
    chosen from the labels alone; only the chosen texts are gathered, and only those within the bounds reach
    the driver, each whole.
    """
    said = labels.select(F.col(id_col).alias("id"),
        F.col(label_col).alias("y")).where("id is not null and y in (0, 1)").where(~held_out("id"))
    known = said.groupBy("id").agg(F.min("y").alias("y"), F.max("y").alias("_z")).where("y = _z").drop("_z")
    share = known.agg(F.avg("y")).first()[0]
    picked = None
    for k in (0, 1):
        one = known.where(F.col("y") == k).orderBy(F.xxhash64("id"), "id").limit(per_class)
        picked = one if picked is None else picked.unionByName(one)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    one = rows.join(F.broadcast(picked), "id").groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    found = written(one, "labelled")
    left, chosen = {0: class_bytes, 1: class_bytes}, []
    for r in found.select("id", "y", F.octet_length("text").alias("n"), F.xxhash64("id").alias("h")).orderBy("h", "id").collect():
        if r["n"] <= left[r["y"]]:
            left[r["y"]] -= r["n"]
            chosen.append(r["id"])
    texts = found.where(F.col("id").isin(chosen)).collect() if chosen else []
    texts.sort(key=lambda r: (r["id"], r["y"]))
    return [r["text"].encode() for r in texts], [int(r["y"]) for r in texts], share


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = 0.3, per_class: int = 2500, class_bytes: int = 48 << 20, whole: bool = False,
          size: int = 40, common_bytes: int = 16384, tail_bytes: int = 1024, least: float = 0.015, lift: float = 6.0,
          near: float = 0.8) -> DataFrame:
    """One row per document: ``(doc_id, held_out, score, predicted)``, and ``row``, all its columns, if ``whole``.

    The model is fitted on at most ``per_class`` labelled texts and ``class_bytes`` of each class whose
    crc32(doc_id as text) mod 4 is not 2, of near copies (word Jaccard ``near`` or more) one.
    The dictionaries hold ``common_bytes`` of ordinary text and ``tail_bytes`` of selected word
    beginnings: those that at least a share ``least`` of a class's texts have, ``lift`` times as
    common as in the other class. Windows have ``size`` bytes. Every whole text is scored, window by window. Null
    and empty texts have no windows and get the score of that; without labels of both classes
    every text gets the share of toxic labels. A null doc_id is not held out; repeated
    rows repeat.
    """
    model = fit(*training_sample(docs, labels, id_col, text_col, label_col, per_class, class_bytes), size=size, common_bytes=common_bytes,
        tail_bytes=tail_bytes, least=least, lift=lift, near=near)
    names = ["row"] if whole else []
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"),
        F.col(text_col).cast("string").alias("text"),
                       *[F.struct("*").alias(n) for n in names])
    kinds = T.StructType([rows.schema["doc_id"], rows.schema["held_out"], T.StructField("score", T.DoubleType()),
        T.StructField("predicted", T.IntegerType()), *[rows.schema[n] for n in names]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        presses = model.presses()
        for batch in batches:
            x = [measures(model.gains(t.as_buffer().to_pybytes() if t.is_valid else b"", presses)) for t in batch.column(2)]
            s = model.score(np.stack(x)) if x else np.zeros(0)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32)),
                *batch.columns[3:]],
                                  ["doc_id", "held_out", "score", "predicted", *names])

    return rows.mapInArrow(run, kinds)
