"""Embedding near-duplicates with spherical k-means cells and blocked cosine products."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, meet, written
from .simhash import forest


def centroids(sample: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Spherical k-means: unit centroids of unit rows, by cosine; an empty cell keeps its centroid."""
    rng = np.random.default_rng(seed)
    c = sample[rng.choice(len(sample), min(k, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([(sample[i : i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(sample), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, near, sample)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 0, total / np.where(norm > 0, norm, 1), c)
    return c


def near_duplicates(vecs: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    least: float = 0.98, per_cell: int = 512, per_centroid: int = 20, sample_rows: int = 20_000,
                    block: int = 512) -> DataFrame:
    """One row per vector: ``(vec_id, n_links, component_id, kept)``.

    Two vectors of one non-null label and one length are linked if their cosine, in double
    precision, is at least ``least``. Vectors that are null, zero or have null or non-finite
    parts, and rows with a null id or label, link with nothing: 0 links, a component of
    their own. Equal vectors are compared once, and count as often as they occur. Rows that
    repeat a vec_id count one by one and share its component.

    There is a cell for every ``per_cell`` vectors, up to the square root of their number, so that
    neither the work of finding a cell nor that inside cells grows with the square of the input. The
    k-means is fitted on ``sample_rows`` vectors, or ``per_centroid`` times the cells if that is
    more (the least hashes of their ids); every vector is placed and compared. A vector's home is its
    nearest centroid; it also visits every cell whose centroid is nearer than a pair's
    distance allows for: of two vectors at distance t or less with homes a and b, one sees
    the other's centroid by at most t/2 * |a - b| worse than its own. So that no pair is
    lost, whatever the cells are. Cells are compared in blocks of ``block`` vectors; a pair of
    blocks is a task's unit, which gives link counts and a spanning star, not its pairs.
    """
    spark = vecs.sparkSession
    id_kind = vecs.schema[id_col].dataType.simpleString()

    def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[bytes | None] = []
            ok = batch.column(2).is_valid().to_pylist()
            known = batch.column(0).is_valid().to_pylist()
            for i, v in enumerate(batch.column(1)):
                x = None
                if ok[i] and known[i] and v.is_valid and len(v) and not v.values.null_count:
                    x = np.asarray(v.values.to_numpy(zero_copy_only=False), np.float64)
                    top = np.abs(x).max()
                    if not np.isfinite(x).all() or top == 0:
                        x = None
                    else:
                        x = x / top
                        x = x / np.linalg.norm(x)
                out.append(None if x is None else (x + 0.0).tobytes())
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(out, pa.binary())], ["vec_id", "label", "unit"])

    label_kind = vecs.schema[label_col].dataType.simpleString()
    rows = written(vecs.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("v"), F.col(label_col).alias("label"))
                   .select("vec_id", "v", "label").mapInArrow(prepare, f"vec_id {id_kind}, label {label_kind}, unit binary"), "units")
    good = rows.where("unit is not null")
    classes = written(good.groupBy("label", "unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")), "classes")
    n = classes.count()
    if not n:
        alone = rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
        return alone.withColumn("kept", F.col("vec_id").isNotNull())
    cells = max(1, min(n // per_cell, max(1024, math.isqrt(n))))
    wanted = max(sample_rows, per_centroid * cells)
    # hashes are even: a bit more than the wanted share of them, so that few rows are sorted
    share = min(1.0, 1.2 * wanted / n + 1000 / n)
    drawn = classes.where(F.pmod(F.xxhash64("id"), F.lit(1 << 40)) < int(share * (1 << 40)))
    taken = drawn.orderBy(F.pmod(F.xxhash64("id"), F.lit(1 << 40)), "id").limit(wanted).select("unit").toPandas()["unit"]
    sample = [np.frombuffer(b) for b in taken]
    by_length = {}
    for size in {len(x) for x in sample}:
        own = np.stack([x for x in sample if len(x) == size])
        by_length[size] = centroids(own, cells)
    slack = np.sqrt(max(0.0, 2 - 2 * least)) / 2 + 1e-9

    def cells_of(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Home of each row and a matrix of the cells it visits."""
        c = by_length.get(x.shape[1])
        if c is None:  # a length that the sample has not: one cell
            return np.zeros(len(x), np.int64), np.ones((len(x), 1), bool)
        near = x @ c.T
        home = near.argmax(axis=1)
        far = np.sqrt(np.maximum(0, 2 - 2 * (c @ c.T)))
        return home, near[np.arange(len(x)), home][:, None] - near <= slack * far[home]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(2).to_pylist()
            width = np.array([len(u) for u in units])
            for size in np.unique(width):
                at = np.flatnonzero(width == size)
                home, visits = cells_of(np.stack([np.frombuffer(units[i]) for i in at]))
                row, cell = np.nonzero(visits)
                src = pa.array(at[row])
                seen = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(visits.sum(axis=1))]), pa.int32()),
                    pa.array(cell.astype(np.int32)))
                yield pa.record_batch([batch.column(0).take(src), pa.array(np.full(len(row), size // 8)), pa.array(cell),
                    pa.array(home[row]),
                                       batch.column(1).take(src), batch.column(2).take(src), batch.column(3).take(src),
                                       seen.take(pa.array(row))],
                                      ["label", "size", "cell", "home", "id", "unit", "n", "visits"])

    placed = classes.select("label", F.col("id").alias("id"), "unit", "n").mapInArrow(
        place, f"label {label_kind}, size long, cell long, home long, id {id_kind}, unit binary, n long, visits array<int>")
    placed = written(placed, "placed")
    spot = F.concat_ws(":", F.col("label").cast("string"), "size", "cell")
    sizes = placed.groupBy(spot.alias("spot")).agg(F.count("*").alias("n"), F.ceil(F.count("*") / block).alias("blocks"))
    dealt = meet(placed.withColumn("spot", spot), sizes, "spot", F.xxhash64("unit")).withColumn("own", F.pmod(F.xxhash64("unit"), "blocks"))
    others = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1),
        lambda j: F.struct(F.least(j, "own").alias("i"), F.greatest(j, "own").alias("j")))
    dealt = dealt.withColumn("pair", F.explode(others)).select("label", "size", "cell", "pair.i", "pair.j", "own", "home", "id", "unit",
        "n", "visits")

    def compare(key: tuple, t: pa.Table) -> pa.Table:
        cell, i, j = key[2].as_py(), key[3].as_py(), key[4].as_py()
        own, home = t["own"].to_numpy(), t["home"].to_numpy()
        units = np.stack([np.frombuffer(b) for b in t["unit"].to_pylist()])
        counts, ids = t["n"].to_numpy(), t["id"].to_numpy()
        seen = t["visits"].combine_chunks()
        homes, spot = np.unique(home, return_inverse=True)
        row = np.repeat(np.arange(len(units)), np.diff(seen.offsets.to_numpy()))
        at = np.searchsorted(homes, seen.flatten().to_numpy())
        known = np.flatnonzero((at < len(homes)) & (homes[np.minimum(at, len(homes) - 1)] == seen.flatten().to_numpy()))
        visits = np.zeros((len(units), len(homes)), bool)  # does a row visit one of the homes here
        visits[row[known], at[known]] = True
        a = np.flatnonzero(own == i)
        b = np.flatnonzero(own == j)
        near = units[a] @ units[b].T >= least
        # a pair is taken in the lower of the two homes that both see, and in none but a home
        la, lb = home[a][:, None], home[b][None, :]
        sees_b = visits[a][:, spot[b]]  # does a visit b's home
        sees_a = visits[b][:, spot[a]].T
        where = np.where(sees_b & sees_a, np.minimum(la, lb), np.where(sees_b, lb, la))
        near &= where == cell
        if i == j:
            np.fill_diagonal(near, False)
        links = np.zeros(len(units), np.int64)
        links[a] += near @ counts[b]
        if i != j:
            links[b] += near.T @ counts[a]
        x, y = np.nonzero(near)
        node, root = forest(len(units), a[x], b[y])
        keep = np.flatnonzero(links)
        star = np.arange(len(units))
        star[node] = root
        return pa.table({"id": pa.array(ids[keep]), "unit": t["unit"].take(pa.array(keep)), "label": t["label"].take(pa.array(keep)),
                         "links": pa.array(links[keep]), "root": pa.array(ids[star[keep]])})

    linked = written(dealt.groupBy("label", "size", "cell", "i", "j").applyInArrow(
        compare, f"id {id_kind}, unit binary, label {label_kind}, links long, root {id_kind}"), "linked")
    comp = components(linked.select(F.col("id").cast("long").alias("u"), F.col("root").cast("long").alias("v"))
                      .unionByName(good.join(classes.where("n > 1"), ["label", "unit"]).select(F.col("vec_id").cast("long").alias("u"),
                      F.col("id").cast("long").alias("v")).distinct()))
    degree = linked.groupBy("label", "unit").agg(F.sum("links").alias("links"))
    per = classes.join(degree, ["label", "unit"], "left").select("label", "unit",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"))
    # rows without a usable vector have nothing to meet, and would all meet in one task
    usable = F.col("unit").isNotNull() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    out = rows.where(usable).join(per, ["label", "unit"]).join(comp, F.col("vec_id").cast("long") == F.col("node"), "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", F.col("vec_id").cast("long")).alias("component_id"))
    out = out.unionByName(rows.where(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").cast("long").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
