"""As-of operators: running-latest merge, as-of join with age, and lateness checks.

All go backward only: a row at time t sees events at or before t. Each is one shuffle and
one sort: a union and ``last(ignorenulls)`` over a rows frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _hour(ts: str, width: int) -> Column:
    return F.expr(f"{ts} div {width}")


def sharded(df: DataFrame, ts: str, shard_ns: int, lookback_ns: int) -> DataFrame:
    """Adds ``bucket`` and ``ghost``: each time bucket also gets, as ghosts, the last
    ``lookback_ns`` of the one before, so that a state no older than that needs no other
    bucket. This splits a hot key's day into many tasks."""
    if lookback_ns > shard_ns:
        raise ValueError("a shard must be at least as long as the lookback")
    own = df.withColumn("bucket", _hour(ts, shard_ns)).withColumn("ghost", F.lit(False))
    tail = own.where(F.col(ts) >= (F.col("bucket") + 1) * shard_ns - lookback_ns).withColumn("bucket",
        F.col("bucket") + 1).withColumn("ghost", F.lit(True))
    return own.unionByName(tail)


def carried(df: DataFrame, by: list[str], keys: list[str], ts: str, order: list[str], shard_ns: int) -> DataFrame:
    """Adds ``bucket`` and ``ghost``: each time bucket also gets, as ghosts, the last row that each of ``keys``
    had in any bucket before it.

    So a state of any age needs no other bucket, and a hot ``by``'s history is many tasks. Beside the rows
    themselves, only the last row of each bucket and key is moved.
    """
    own = df.withColumn("bucket", _hour(ts, shard_ns)).withColumn("ghost", F.lit(False))
    cols = list(df.columns)
    lasts = own.groupBy(*by, *keys, "bucket").agg(F.max_by(F.struct(*cols), F.struct(ts, *order)).alias("_last"))
    every = own.select(*by, "bucket").distinct().join(own.select(*by, *keys).distinct(), by)
    same = [*by, *keys, "bucket"]
    before = Window.partitionBy(*by, *keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    state = every.join(lasts, same, "left").withColumn("_state", F.last("_last", ignorenulls=True).over(before)).where("_state is not null")
    ghosts = state.select(*[F.col("_state")[c].alias(c) for c in cols], "bucket", F.lit(True).alias("ghost"))
    return own.unionByName(ghosts)


def merge_latest(df: DataFrame, by: list[str], key: str, keys: list[str], ts: str, order: list[str], value: Column) -> DataFrame:
    """One row per ``by`` and distinct ``ts``: ``latest``, a map from key to its last value so far.

    ``keys`` names the streams to merge. Events of one time all apply before its row. A value
    is carried as it is, so that a struct that says "gone" evicts.
    """
    run = Window.partitionBy(*by).orderBy(ts, *order).rowsBetween(Window.unboundedPreceding, 0)
    nxt = Window.partitionBy(*by).orderBy(ts, *order)
    latest = F.map_from_arrays(F.array(*[F.lit(k) for k in keys]),
        F.array(*[F.last(F.when(F.col(key) == k, value), ignorenulls=True).over(run) for k in keys]))
    return (df.withColumn("latest", latest).withColumn("_next", F.lead(ts).over(nxt))
            .where(F.col("_next").isNull() | (F.col("_next") != F.col(ts))).drop("_next"))


def nbbo(quotes: DataFrame, venues: list[str], max_age_ns: int | None, downs: DataFrame | None = None,
    shard_ns: int | None = None) -> DataFrame:
    """Best bid and offer over venues: ``(symbol, ts_ns, best_bid, best_ask, bid_venue, ask_venue, n_venues)``.

    ``quotes(symbol, venue, ts_ns, arrival, bid, ask)``. A leg leaves when it is older than
    ``max_age_ns`` or its venue goes down (``downs(venue, ts_ns)``; a down at a quote's time
    comes after it). Ties: the bid goes to the largest venue name, the ask to the smallest.
    Times without a live leg give no row. With ``shard_ns``, a symbol's history is split into buckets
    of that length, which are tasks of their own.
    """
    rows = quotes.select("symbol", "venue", "ts_ns", F.lit(0).alias("late"), "arrival",
        F.struct(F.lit(True).alias("alive"), F.col("ts_ns").alias("at"), "bid", "ask").alias("v"))
    if downs is not None:
        gone = quotes.select("symbol", "venue").distinct().join(downs.select("venue", "ts_ns"), "venue")
        kinds = {f.name: f.dataType for f in quotes.schema}
        gone = gone.select("symbol", "venue", "ts_ns", F.lit(1).alias("late"), F.lit(0).cast("long").alias("arrival"),
                           F.struct(F.lit(False).alias("alive"), F.col("ts_ns").alias("at"), F.lit(None).cast(kinds["bid"]).alias("bid"),
                           F.lit(None).cast(kinds["ask"]).alias("ask")).alias("v"))
        rows = rows.unionByName(gone)
    by = ["symbol"]
    if shard_ns:
        rows = carried(rows, by, ["venue"], "ts_ns", ["late", "arrival"], shard_ns) if max_age_ns is None else sharded(rows, "ts_ns",
            shard_ns, max_age_ns)
        by = ["symbol", "bucket"]
    merged = merge_latest(rows, by, "venue", venues, "ts_ns", ["late", "arrival"], F.col("v"))
    if shard_ns:
        merged = merged.where(~F.col("ghost"))
    legs = F.transform(F.map_entries("latest"), lambda e: F.struct(e["key"].alias("venue"), e["value"].alias("v")))
    fresh = F.filter(legs, lambda x: x["v"].isNotNull() & x["v"]["alive"]
        & (F.lit(True) if max_age_ns is None else F.col("ts_ns") - x["v"]["at"] <= max_age_ns))
    live = merged.withColumn("live", fresh).where(F.size("live") > 0)
    bid = F.array_max(F.transform("live", lambda x: F.struct(x["v"]["bid"].alias("px"), x["venue"].alias("venue"))))
    ask = F.array_min(F.transform("live", lambda x: F.struct(x["v"]["ask"].alias("px"), x["venue"].alias("venue"))))
    return live.select("symbol", "ts_ns", bid["px"].alias("best_bid"), ask["px"].alias("best_ask"), bid["venue"].alias("bid_venue"),
        ask["venue"].alias("ask_venue"), F.size("live").cast("long").alias("n_venues"))


def basis(nbbos: DataFrame, pairs: DataFrame, max_age_ns: int) -> DataFrame:
    """Spread of a base's USD leg over its USDT leg at every tick where both are fresh.

    ``pairs(base, usd, usdt)``; ``(base, ts_ns, usd_mid2, usdt_mid2, basis2)`` in twice the
    price unit, so that whole numbers stay whole, and ``basis_bps``.
    """
    legs = pairs.select("base", F.col("usd").alias("symbol"), F.lit("usd").alias("leg")).unionByName(pairs.select("base",
        F.col("usdt").alias("symbol"), F.lit("usdt").alias("leg")))
    ticks = nbbos.join(F.broadcast(legs), "symbol").select("base", "leg", "ts_ns",
        F.struct(F.col("ts_ns").alias("at"), (F.col("best_bid") + F.col("best_ask")).alias("mid2")).alias("v"))
    merged = merge_latest(ticks, ["base"], "leg", ["usd", "usdt"], "ts_ns", [], F.col("v"))
    usd, usdt = F.col("latest")["usd"], F.col("latest")["usdt"]
    ok = usd.isNotNull() & usdt.isNotNull() & (F.col("ts_ns") - usd["at"] <= max_age_ns) & (F.col("ts_ns") - usdt["at"] <= max_age_ns)
    out = merged.where(ok).select("base", "ts_ns", usd["mid2"].alias("usd_mid2"), usdt["mid2"].alias("usdt_mid2"))
    return out.withColumn("basis2", F.col("usd_mid2") - F.col("usdt_mid2")).withColumn("basis_bps",
        F.col("basis2").cast("double") / F.col("usd_mid2") * 1e4)


def asof_join(grid: DataFrame, series: DataFrame, by: list[str], ts: str, order: list[str], cols: list[str], age: str = "age_ns",
    shard_ns: int | None = None) -> DataFrame:
    """Each grid row with the last series row at or before it (the last by ``order`` among ties) and its age.

    With ``shard_ns``, a key's history is split into buckets of that length, which are tasks of their own."""
    g = grid.select(*by, ts, F.lit(1).alias("_grid"), *[F.lit(None).cast("long").alias(o) for o in order],
        F.lit(None).cast(f"struct<{','.join(f'`{c}`:{series.schema[c].dataType.simpleString()}' for c in cols)},_at:bigint>").alias("_v"))
    s = series.select(*by, ts, F.lit(0).alias("_grid"), *[F.col(o).cast("long").alias(o) for o in order],
        F.struct(*cols, F.col(ts).cast("long").alias("_at")).alias("_v"))
    both, keys = g.unionByName(s), by
    if shard_ns:
        # of a bucket's rows the last with a value is carried on: the grid's rows have none
        buckets = g.withColumn("bucket", _hour(ts, shard_ns)).select(*by, "bucket").distinct()
        lasts = s.withColumn("bucket", _hour(ts, shard_ns)).groupBy(*by,
            "bucket").agg(F.max_by(F.struct(ts, "_grid", *order, "_v"), F.struct(ts, "_grid", *order)).alias("_l"))
        before = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        every = buckets.unionByName(lasts.select(*by, "bucket")).distinct().join(lasts, [*by, "bucket"], "left").withColumn("_state",
            F.last("_l", ignorenulls=True).over(before))
        marks = every.where("_state is not null").select(*by, "_state.*", "bucket")
        both = both.withColumn("bucket", _hour(ts, shard_ns)).unionByName(marks)
        keys = [*by, "bucket"]
    run = Window.partitionBy(*keys).orderBy(ts, "_grid", *order).rowsBetween(Window.unboundedPreceding, 0)
    both = both.withColumn("_v", F.last("_v", ignorenulls=True).over(run)).where("_grid = 1")
    return both.select(*by, ts, *[F.col("_v")[c].alias(c) for c in cols], (F.col(ts) - F.col("_v")["_at"]).alias(age))


def lateness(events: DataFrame, by: list[str], ts: str, arrival: str, window_ns: int) -> DataFrame:
    """``late``: whether an event arrives below what a reorder buffer of ``window_ns`` has let go.

    The buffer lets go of an event when the highest time that has arrived is ``window_ns`` above it.
    That moment is found among the arrivals that raised the highest time, by one sort by time;
    the highest time let go so far is then a running maximum by arrival.
    """
    upto = Window.partitionBy(*by).orderBy(arrival).rowsBetween(Window.unboundedPreceding, 0)
    peaks = events.select(*by, F.col(arrival).alias("_a"), F.max(ts).over(upto).alias("_x"), F.lit(0).alias("_ask"),
        F.lit(None).cast("long").alias("_ts"))
    asks = events.select(*by, F.col(arrival).alias("_a"), (F.col(ts) + window_ns).alias("_x"), F.lit(1).alias("_ask"),
        F.col(ts).cast("long").alias("_ts"))
    high_first = Window.partitionBy(*by).orderBy(F.desc("_x"), "_ask").rowsBetween(Window.unboundedPreceding, 0)
    raised = F.min(F.when(F.col("_ask") == 0, F.col("_a"))).over(high_first)
    gone = peaks.unionByName(asks).withColumn("_r", raised).where("_ask = 1 and _r is not null")
    gone = gone.select(*by, F.greatest("_r", "_a").alias(arrival), F.col("_ts")).groupBy(*by, arrival).agg(F.max("_ts").alias("_gone"))
    before = Window.partitionBy(*by).orderBy(arrival).rowsBetween(Window.unboundedPreceding, -1)
    met = events.join(gone, [*by, arrival], "left").withColumn("_out", F.max("_gone").over(before))
    return met.withColumn("late", F.coalesce(F.col(ts) < F.col("_out"), F.lit(False))).drop("_gone", "_out")


def reorder(events: DataFrame, by: list[str], ts: str, arrival: str, window_ns: int) -> DataFrame:
    """The events with ``position``, their place by (time, arrival); fails on one that is too late (:func:`lateness`)."""
    place = F.row_number().over(Window.partitionBy(*by).orderBy(ts, arrival))
    stop = F.raise_error(F.concat(F.lit("event beyond the lateness window at "), F.col(ts).cast("string"))).cast("int")
    return lateness(events, by, ts, arrival, window_ns).withColumn("position", F.when(F.col("late"), stop).otherwise(place)).drop("late")
