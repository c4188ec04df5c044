"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, partitions, written

EPOCHS = 3


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: int = 3, epochs: int = EPOCHS) -> DataFrame:
    """``sources(source, source_size)`` to ``(source, source_size, rank, target)``.

    Sources by code point, null last, weigh 1, 2, ..., ``weights``, repeating, and share the
    sum of all sizes; a target stops at ``epochs`` times its source's size and the excess is
    shared anew by weight until none is above. That fixed point is a water level: with the
    sources ordered by cap over weight, the level is the largest of (total - caps before) /
    (weights from here on). The table has one row per source.
    """
    listed = sources.select(
        "source", "source_size",
        F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")).alias("rank")
    ).withColumn("w", ((F.col("rank") - 1) % weights + 1).cast("double")).withColumn("cap", (F.col("source_size") * epochs).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum(F.col("source_size").cast("double")).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    leveled = listed.withColumn("level", (total - before) / rest)
    level = F.max("level").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return leveled.select("source", "source_size", "rank", F.least(level * F.col("w"), F.col("cap")).alias("target"))


def _prefix(cells: DataFrame, bits: int) -> DataFrame:
    """``cells(source, part, cell)`` with ``before``: the sum of a source's cells below ``part``.

    Cells are summed by the upper half of the part's bits first, so that no window holds more
    than the square root of a source's cells.
    """
    low = bits // 2
    parts = cells.withColumn("upper", F.shiftright("part", low))
    until = lambda *keys: Window.partitionBy(*keys[:-1]).orderBy(keys[-1]).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    uppers = parts.groupBy("source", "upper").agg(F.sum("cell").alias("n"))
    uppers = uppers.select(F.col("source").alias("s"), F.col("upper").alias("u"),
        F.coalesce(F.sum("n").over(until("source", "upper")), zero).alias("base"))
    inner = parts.withColumn("inner", F.coalesce(F.sum("cell").over(until("source", "upper", "part")), zero))
    met = inner.join(uppers, F.col("source").eqNullSafe(F.col("s")) & (F.col("upper") == F.col("u")))
    return met.select("source", "part", (F.col("base") + F.col("inner")).alias("before"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", key_col: str | None = None,
        weights: int = 3, epochs: int = EPOCHS, seed: int = 7, spread: int | None = None, per_range: int = 1_000_000) -> DataFrame:
    """One row per document: ``(doc_id, size, source_size, target, taken)``, and ``key``, of ``key_col``, if one is named.

    Each source's documents stand in the order of a hash of doc_id and text; document d's k-th
    copy has the virtual finish time (words of the source up to and with it) / target. All
    copies, as narrow rows without texts, are range-sorted by that time over all sources, and
    taken until the next would pass the total budget, which is the sum of all sizes. Null
    texts have size 0 and are never taken; null sources are one source; rows equal in all of
    these stand one after the other and are taken one by one; sources may be one or many; an
    empty table gives an empty result. The order is the same in each run.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.md5(text.cast("binary")))
    keys = [] if key_col is None else ["key"]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        n_words(F.col(text_col)).alias("size"),
                       F.conv(F.substring(F.md5(named.cast("binary")), 1, 15), 16, 10).cast("long").alias("h"),
                       *[F.col(key_col).alias(k) for k in keys])
    # equal rows are one row until they have their places
    counted = rows.withColumn("times", F.lit(1).cast("long")) if keys else rows.groupBy("doc_id", "source", "size",
        "h").agg(F.count("*").alias("times"))
    sized = written(counted, "sized")
    facts = sized.agg(F.count("*").alias("n"), F.sum(F.col("size") * F.col("times")).alias("budget"), F.max("times").alias("times")).first()
    budget = facts["budget"] or 0
    bits = ((spread or max(1, facts["n"] // 512)) - 1).bit_length()
    sized = sized.withColumn("part", F.shiftright("h", 60 - bits)).withColumn("words", F.col("size") * F.col("times"))
    cells = _prefix(sized.groupBy("source", "part").agg(F.sum("words").alias("cell")), bits)
    # one row for each source: small enough for Spark to broadcast, or joined as a table
    per_source = written(targets(sized.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs), "targets")
    own = Window.partitionBy("source", "part").orderBy("h", "doc_id", "size", *keys).rowsBetween(Window.unboundedPreceding, -1)
    inner = sized.withColumn("inner", F.coalesce(F.sum("words").over(own), F.lit(0).cast("long")))
    s, c, t = inner.alias("s"), cells.alias("c"), per_source.alias("t")
    groups = (
        s.join(c, F.col("s.source").eqNullSafe(F.col("c.source")) & (F.col("s.part") == F.col("c.part")))
        .join(t, F.col("s.source").eqNullSafe(F.col("t.source")))
        .select("s.doc_id", "s.size", "s.times", "t.source_size", "t.target", "t.rank",
        (F.col("c.before") + F.col("s.inner")).alias("before"), *[f"s.{k}" for k in keys])
    )
    if (facts["times"] or 1) > 1:
        block = 4096  # a large group is dealt out in blocks before it is unfolded
        blocks = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {block}"))))
        if facts["times"] > block:
            blocks = blocks.repartition("rank", "before", "block")
        last = F.least(F.col("times"), (F.col("block") + 1) * block)
        groups = blocks.withColumn("nth", F.explode(F.sequence(F.col("block") * block + 1, last)))
    else:
        groups = groups.withColumn("nth", F.lit(1).cast("long"))
    placed = written(groups.select("doc_id", "size", "source_size", "target", "rank",
        (F.col("before") + F.col("size") * F.col("nth")).alias("upto"), *keys), "placed")

    def place(e: Column) -> Column:
        return F.col("upto") + e * F.col("source_size")

    order = ["finish", "rank", "place"]
    copies = (
        placed.where("size > 0").select("size", "target", "rank", "upto", "source_size",
        F.explode(F.array(*[F.lit(e).cast("long") for e in range(epochs)])).alias("epoch"))
        .withColumn("place", place(F.col("epoch"))).withColumn("finish", F.col("place") / F.col("target")).select("size", *order)
    )
    ranges = max(partitions(docs.sparkSession), epochs * facts["n"] // per_range)
    # the global range sort; each range keeps its number, and the table its sizes by range
    lined = written(copies.repartitionByRange(ranges, *order).withColumn("range", F.spark_partition_id()), "lined")
    sums = lined.groupBy("range").agg(F.sum("size").alias("n"))
    so_far = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, 0))
    cut = sums.withColumn("upto", so_far).where(F.col("upto") > budget).orderBy("range").first()
    stop = None
    if cut is not None:  # the first copy that is not taken lies in this range
        run = Window.partitionBy("range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        at = lined.where(F.col("range") == cut["range"]).withColumn("run", F.sum("size").over(run) + (cut["upto"] - cut["n"]))
        stop = at.where(F.col("run") > budget).agg(F.min(F.struct(*order))).first()[0]

    def is_taken(e: int) -> Column:
        if stop is None:
            return F.lit(1)
        p = place(F.lit(e).cast("long"))
        key = F.struct((p / F.col("target")).alias("finish"), F.col("rank"), p.alias("place"))
        bound = F.struct(F.lit(stop["finish"]).alias("finish"), F.lit(stop["rank"]).cast("int").alias("rank"),
            F.lit(stop["place"]).cast("long").alias("place"))
        return (key < bound).cast("int")

    times = sum((is_taken(e) for e in range(epochs)), F.lit(0))
    taken = F.when(F.col("size") > 0, F.col("size") * times).otherwise(F.lit(0)).cast("long")
    return placed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), *keys)
