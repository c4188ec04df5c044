"""What a dashboard shows of the feed: tables of tops, a matrix of venues, stale legs, message rates.

Ages are data against data: the clock is the highest event time seen, so that a replayed log shows
the same as a live one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: When a leg is stale, and the span that rates are over.
STALE_NS, RATE_NS = 3_000_000_000, 5_000_000_000


def pair_of(symbol: Column) -> Column:
    """A venue's symbol as base and quote without separators, in upper case."""
    return F.upper(F.regexp_replace(symbol, "[^a-zA-Z0-9]", ""))


def tops(bbos: DataFrame, by: list[str], order: str) -> DataFrame:
    """The latest top of each stream with spread, mid, whether it is crossed, and how it moved: up if the bid rose,
    else down if the ask fell, against the top before."""
    w = Window.partitionBy(*by).orderBy(order)
    last = bbos.withColumn("_pb", F.lag("bid").over(w)).withColumn("_pa", F.lag("ask").over(w)).withColumn("_n",
        F.lead(order).over(w)).where("_n is null")
    tick = F.when(F.col("bid") > F.col("_pb"), "up").when(F.col("ask") < F.col("_pa"), "down")
    return last.select(*by, "ts_ns", "bid", "ask", (F.col("ask") - F.col("bid")).alias("spread"),
        ((F.col("ask") + F.col("bid")) / 2).alias("mid"), (F.col("ask") < F.col("bid")).alias("crossed"), tick.alias("tick"))


def stale(rows: DataFrame, ts: str, clock: DataFrame, most_ns: int = STALE_NS) -> DataFrame:
    """``age_ms`` against the stream clock, and whether that is too old; ``clock(now_ns)`` has one row."""
    met = rows.join(F.broadcast(clock), F.lit(True))
    age = F.greatest(F.lit(0), F.col("now_ns") - F.col(ts))
    return met.withColumn("age_ms", age / 1e6).withColumn("stale", age > most_ns).drop("now_ns")


def now(rows: DataFrame, ts: str) -> DataFrame:
    return rows.agg(F.max(ts).alias("now_ns"))


def venues(messages: DataFrame, ts: str, most_ns: int = STALE_NS) -> DataFrame:
    """Each venue's messages, its latest time, and whether it fell behind the stream clock."""
    per = messages.groupBy("venue").agg(F.count("*").alias("n_messages"), F.max(ts).alias("last_ns"))
    return stale(per, "last_ns", now(messages, ts), most_ns)


def matrix(tops_now: DataFrame, venue_names: list[str], clock: DataFrame) -> DataFrame:
    """Instruments by venues: each cell the mid and its age in milliseconds, null where a venue does not quote."""
    aged = stale(tops_now, "ts_ns", clock)
    cell = F.first(F.struct("mid", "age_ms"))
    wide = aged.groupBy("symbol").pivot("venue", venue_names).agg(cell)
    return wide.select("symbol", *[F.col(f"`{v}`.{k}").alias(f"{v}_{k}") for v in venue_names for k in ("mid", "age_ms")])


def rates(messages: DataFrame, by: list[str], ts: str, span_ns: int = RATE_NS) -> DataFrame:
    """Messages in the ``span_ns`` up to each one, by second."""
    w = Window.partitionBy(*by).orderBy(ts).rangeBetween(-(span_ns - 1), 0)
    return messages.withColumn("n_in_span", F.count("*").over(w)).withColumn("per_second", F.col("n_in_span") / (span_ns / 1e9))


def stalls(messages: DataFrame, by: list[str], ts: str, most_ns: int = STALE_NS) -> DataFrame:
    """When the feed stood still for longer than ``most_ns``: the last message before, and for how long."""
    gap = F.lead(ts).over(Window.partitionBy(*by).orderBy(ts)) - F.col(ts)
    return messages.withColumn("stalled_ns", gap).where(F.col("stalled_ns") > most_ns).select(*by, ts, "stalled_ns")


def consolidated(nbbos: DataFrame, order: str, clock: DataFrame, most_ns: int = STALE_NS) -> DataFrame:
    """The latest best of each instrument with its legs, spread, mid, and which leg is stale."""
    w = Window.partitionBy("symbol").orderBy(order)
    last = nbbos.withColumn("_n", F.lead(order).over(w)).where("_n is null").join(F.broadcast(clock), F.lit(True))
    old = lambda c: F.greatest(F.lit(0), F.col("now_ns") - F.col(c)) > most_ns
    return last.select("symbol", "best_bid", "bid_venue", "best_ask", "ask_venue", (F.col("best_ask") - F.col("best_bid")).alias("spread"),
        ((F.col("best_ask") + F.col("best_bid")) / 2).alias("mid"),
                       (F.col("best_ask") < F.col("best_bid")).alias("crossed"), "n_venues", old("bid_at").alias("bid_stale"),
                       old("ask_at").alias("ask_stale"))
