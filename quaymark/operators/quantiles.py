"""Exact percentiles of large groups in two passes: find the range that holds them, then look inside."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BINS = 4096


def percentiles(rows: DataFrame, by: list[str], value: str, shares: list[float], bins: int = BINS, small: int = 100_000) -> DataFrame:
    """``(*by, p array<double>)``: linear percentiles of ``value``, nulls left out; one row a group that has a value.

    The built-in aggregate keeps every distinct value of a group in one task. Here a group is
    first counted in ``bins`` equal ranges of its values, which map-side aggregation does; only
    the ranges that hold the wanted places are then ranked, with equal values as one row. Groups of up to
    ``small`` rows, and those whose values are all in one range, go straight to the aggregate.
    """
    if not by:
        return percentiles(rows.withColumn("_one", F.lit(1)), ["_one"], value, shares, bins, small).drop("_one")
    x = F.col(value).cast("double")
    known = rows.where(F.col(value).isNotNull()).select(*by, x.alias("_x"))
    span = known.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))

    def same(a: str, b: str, cols: list[str]) -> Column:
        return reduce(Column.__and__, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in cols], F.lit(True))

    few = (F.col("_n") <= small) | (F.col("_lo") == F.col("_hi")) | F.isnan("_lo") | F.isnan("_hi") | (F.abs("_lo") == float("inf")) | (F.abs("_hi") == float("inf"))
    marked = known.alias("k").join(span.withColumn("_few", few).alias("s"), same("k", "s", by)).select(*[f"k.{c}" for c in by], "_x", "_n",
        "_lo", "_hi", "_few")
    direct = marked.where("_few").groupBy(*by).agg(F.percentile("_x", F.array(*[F.lit(q) for q in shares])).alias("p"))
    at = F.least(F.lit(bins - 1), F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins)).cast("int")
    binned = marked.where("not _few").withColumn("_bin", at)
    counts = binned.groupBy(*by, "_bin").agg(F.count("*").alias("_in"), F.first("_n").alias("_n"))
    upto = counts.withColumn("_before",
        F.sum("_in").over(Window.partitionBy(*by).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_in"))
    # places are from 0; a percentile lies between the two around share * (n - 1)
    place = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(q) * (F.col("_n") - 1)).alias("at")) for i, q in enumerate(shares)]))
    wanted = span.where(~few).select(*by, "_n", place.alias("w")).select(*by, "w.i", "w.at",
        F.explode(F.array_distinct(F.array(F.floor("w.at"), F.ceil("w.at")))).alias("_place"))
    holds = (F.col("w._place") >= F.col("u._before")) & (F.col("w._place") < F.col("u._before") + F.col("u._in"))
    spots = wanted.alias("w").join(upto.alias("u"), same("w", "u", by) & holds).select(*[f"w.{c}" for c in by], "i", "at", "_place", "_bin",
        "_before")
    chosen = spots.select(*by, "_bin", "_before").distinct()
    inside = binned.alias("b").join(chosen.alias("c"), same("b", "c", [*by, "_bin"])).select(*[f"b.{c}" for c in by],
        F.col("b._bin").alias("_bin"), "_x", "_before")
    values = inside.groupBy(*by, "_bin", "_before", "_x").agg(F.count("*").alias("_m"))
    last = F.col("_before") + F.sum("_m").over(Window.partitionBy(*by, "_bin").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    ranked = values.withColumn("_end", last).withColumn("_begin", F.col("_end") - F.col("_m"))
    covers = (F.col("s._place") >= F.col("r._begin")) & (F.col("s._place") < F.col("r._end"))
    found = spots.alias("s").join(ranked.alias("r"), same("s", "r", [*by, "_bin"]) & covers).select(*[f"s.{c}" for c in by], "i", "at",
        F.col("s._place").alias("_place"), "_x")
    low, high = F.min_by("_x", "_place"), F.max_by("_x", "_place")
    one = found.groupBy(*by, "i").agg((low + (high - low) * (F.first("at") - F.floor(F.first("at")))).alias("v"))
    spread = one.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "v"))), lambda z: z["v"]).alias("p"))
    return direct.unionByName(spread)
