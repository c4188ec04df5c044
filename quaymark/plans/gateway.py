"""Queries over the live gateway's operators, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaymark.operators import asof, scorecard
from quaymark.plans.market import BASE, H, VENUES, query, quotes
from quaymark.streaming import gateway

#: Tops and status changes in the order of the log; a venue's status goes to every instrument.
EVENTS = """, ev AS (SELECT symbol AS canonical, arrival * 2 AS position, ts_ns, venue AS exchange, CAST(bid // 20000 AS VARCHAR) AS bid_px, CAST(k % 3 AS VARCHAR) AS bid_sz, CAST(ask // 20000 AS VARCHAR) AS ask_px, CAST(k % 4 AS VARCHAR) AS ask_sz,
  NULL::BOOLEAN AS down FROM q WHERE k >= 10 UNION ALL SELECT s.symbol, arrival * 2 + 1, ts_ns, venue, NULL, NULL, NULL, NULL, state = 'down' FROM q, (SELECT DISTINCT symbol FROM q) s WHERE k < 10)"""


def events(spark: SparkSession, sf: str) -> DataFrame:
    q = quotes(spark, sf)
    text = lambda e: F.expr(e).cast("string")
    tops = q.where("k >= 10").select(F.col("symbol").alias("canonical"), (F.col("arrival") * 2).alias("position"), "ts_ns",
        F.col("venue").alias("exchange"), text("bid div 20000").alias("bid_px"), text("k % 3").alias("bid_sz"),
                                     text("ask div 20000").alias("ask_px"), text("k % 4").alias("ask_sz"),
                                     F.lit(None).cast("string").alias("state"))
    none = F.lit(None).cast("string")
    names = F.broadcast(q.select(F.col("symbol").alias("canonical")).distinct())  # the instrument table: a row each
    status = q.where("k < 10").select((F.col("arrival") * 2 + 1).alias("position"), "ts_ns", F.col("venue").alias("exchange"),
        "state").join(names, F.lit(True))
    return tops.unionByName(status.select("canonical", "position", "ts_ns", "exchange", none.alias("bid_px"), none.alias("bid_sz"),
        none.alias("ask_px"), none.alias("ask_sz"), "state"))


def _best_sql() -> str:
    w = "OVER (PARTITION BY canonical ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    b = "OVER (PARTITION BY canonical ORDER BY position ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    leg = "CASE WHEN down IS NULL AND exchange = '{v}' THEN {{'bp': bid_px, 'bs': bid_sz, 'ap': ask_px, 'az': ask_sz, 'seen': ts_ns}} END"
    cols = ", ".join(f"last_value({leg.format(v=v)} IGNORE NULLS) {w} AS l{i}, coalesce(last_value(CASE WHEN exchange = '{v}' THEN down END IGNORE NULLS) {w}, false) AS d{i}, "
                     f"coalesce(last_value(CASE WHEN exchange = '{v}' THEN down END IGNORE NULLS) {b}, false) AS p{i}" for i,
                     v in enumerate(VENUES))
    legs = " UNION ALL ".join(f"SELECT canonical, position, '{v}' AS v, l{i}.bp AS bp, l{i}.bs AS bs, l{i}.ap AS ap, l{i}.az AS az, l{i}.seen AS seen FROM st WHERE l{i} IS NOT NULL AND NOT d{i}" for i, v in enumerate(VENUES))
    own = lambda c: "CASE exchange " + " ".join(f"WHEN '{v}' THEN {c}{i}" for i, v in enumerate(VENUES)) + " END"
    has = "CASE exchange " + " ".join(f"WHEN '{v}' THEN l{i} IS NOT NULL" for i, v in enumerate(VENUES)) + " END"
    return BASE + EVENTS + f""", st AS (SELECT *, max(ts_ns) {w} AS clock, {cols} FROM ev), legs AS ({legs}),
bid AS (SELECT canonical, position, v AS bid_venue, bp AS bid_px, bs AS bid_sz, seen AS bid_at FROM legs QUALIFY row_number() OVER (PARTITION BY canonical, position ORDER BY CAST(bp AS DECIMAL(38,9)) DESC, CAST(bs AS DECIMAL(38,9)) DESC, v) = 1),
ask AS (SELECT canonical, position, v AS ask_venue, ap AS ask_px, az AS ask_sz, seen AS ask_at FROM legs QUALIFY row_number() OVER (PARTITION BY canonical, position ORDER BY CAST(ap AS DECIMAL(38,9)), CAST(az AS DECIMAL(38,9)) DESC, v) = 1),
num AS (SELECT canonical, position, count(*) AS n_venues FROM legs GROUP BY ALL),
al AS (SELECT st.canonical, st.position, st.ts_ns, st.clock, st.down IS NULL AS quote, coalesce({own('p')} <> st.down, false) AND {has} AS turned, bid_venue, ask_venue, bid.bid_px, bid.bid_sz, ask.ask_px, ask.ask_sz, bid_at, ask_at, n_venues,
  bid.bid_px || '|' || bid.bid_sz || '|' || ask.ask_px || '|' || ask.ask_sz AS best FROM st LEFT JOIN bid USING (canonical, position) LEFT JOIN ask USING (canonical, position) LEFT JOIN num USING (canonical, position)),
se AS (SELECT *, CASE WHEN turned OR (quote AND best IS NOT NULL) THEN coalesce(best, 'none') END AS sets FROM al),
ol AS (SELECT *, last_value(sets IGNORE NULLS) {b} AS old FROM se),
emitted AS (SELECT * FROM ol WHERE best IS NOT NULL AND (turned OR (quote AND (old IS NULL OR old <> best))))
"""


COLS = "canonical, position, ts_ns, bid_venue, ask_venue, bid_px, bid_sz, ask_px, ask_sz, n_venues, clock, bid_at, ask_at"


@query(_best_sql() + f"SELECT {COLS} FROM emitted")
def gateway_best(spark, sf):
    """The best over venues as the gateway emits it, by windows."""
    ev = events(spark, sf).withColumn("down", F.col("state") == "down").drop("state")
    return gateway.best_legs(ev, VENUES)


@query(_best_sql() + """SELECT canonical, position, CAST(ask_px AS BIGINT) < CAST(bid_px AS BIGINT) AS crossed, round(CASE WHEN CAST(bid_px AS BIGINT) + CAST(ask_px AS BIGINT) > 0 THEN -CAST(CAST(ask_px AS BIGINT) - CAST(bid_px AS BIGINT) AS DOUBLE)
  / (CAST(CAST(bid_px AS BIGINT) + CAST(ask_px AS BIGINT) AS DOUBLE) / 2) * 10000.0 ELSE 0 END, 6) + 0.0::DOUBLE AS cross_bps, CAST(greatest(0, clock - bid_at) AS DOUBLE) / 1000000.0 AS bid_age_ms, CAST(ask_px AS BIGINT) < CAST(bid_px AS BIGINT)
  AND greatest(0, clock - bid_at) <= 36000000000000 AND greatest(0, clock - ask_at) <= 36000000000000 AND round(-CAST(CAST(ask_px AS BIGINT) - CAST(bid_px AS BIGINT) AS DOUBLE) / (CAST(CAST(bid_px AS BIGINT) + CAST(ask_px AS BIGINT) AS DOUBLE) / 2) * 10000.0, 6) >= 0.2 AS material FROM emitted""")
def gateway_crosses(spark, sf):
    """Each emitted best's cross, its depth and leg age, and whether it is worth an alert."""
    best = gateway_best(spark, sf).select("*", F.col("bid_px").cast("double").alias("b"), F.col("ask_px").cast("double").alias("a"))
    spread, mid = F.col("a") - F.col("b"), (F.col("a") + F.col("b")) / 2
    crossed = gateway.decimal(F.col("ask_px")) < gateway.decimal(F.col("bid_px"))
    ages = [gateway.leg_age_ms(F.col("clock"), F.col(c)) for c in ("bid_at", "ask_at")]
    return best.select("canonical", "position", crossed.alias("crossed"),
        (F.round(gateway.cross_bps(spread, mid), 6) + 0.0).alias("cross_bps"), ages[0].alias("bid_age_ms"),
                       (gateway.fresh_cross(crossed, *ages, 10 * H / 1e6)
                       & (F.round(gateway.cross_bps(spread, mid), 6) >= 0.2)).alias("material"))


@query(None)
def gateway_stream(spark, sf):
    """The consolidated state machine over the whole log, silent venues included; a stream gives the same rows."""
    return gateway.consolidated(events(spark, sf), 12 * H)


def book_records(spark: SparkSession, sf: str) -> DataFrame:
    """Events as book messages of one level: snapshots now and then, an epoch of a thousand, late and early ones among them."""
    q = quotes(spark, sf)
    level = lambda px: F.array(F.struct(F.expr(f"{px} div 20000").cast("string").alias("px"),
        F.expr("k % 5").cast("string").alias("sz")))
    none = F.array().cast("array<struct<px:string,sz:string>>")
    snap = F.col("k") % 25 == 0
    seq = F.row_number().over(Window.partitionBy("venue", "symbol").orderBy("arrival")).cast("long")
    q = q.withColumn("seq", seq)
    return q.select(F.col("venue").alias("exchange"), "symbol", F.col("arrival").alias("position"),
        F.when(snap, "snap").otherwise("delta").alias("kind"), F.expr("seq div 60").alias("epoch"),
                    (F.col("seq") - F.when(snap, F.col("k") % 2 * 3).otherwise(0)).alias("sequence"),
                    F.when(snap | (F.col("side") == "bid"), level("bid")).otherwise(none).alias("bids"),
                    F.when(snap | (F.col("side") == "ask"), level("ask")).otherwise(none).alias("asks"), "ts_ns")


@query(None)
def gateway_books(spark, sf):
    """What became of every book message, and the tops that changed."""
    return gateway.live_books(book_records(spark, sf), held=50)


@query(BASE + """, r AS (SELECT symbol, arrival, ts_ns - (k % 7) * 1200000000000 AS ts_ns FROM q), m AS (SELECT *, max(ts_ns) OVER (PARTITION BY symbol ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1800000000000 AS cut FROM r)
SELECT a.symbol, a.arrival, a.ts_ns, EXISTS (SELECT 1 FROM r b WHERE b.symbol = a.symbol AND b.arrival < a.arrival AND b.ts_ns > a.ts_ns AND b.ts_ns <= a.cut) AS late FROM m a""")
def late_events(spark, sf):
    """Which events a reorder buffer of half an hour has to refuse."""
    q = quotes(spark, sf).select("symbol", "arrival", (F.col("ts_ns") - (F.col("k") % 7) * 1_200_000_000_000).alias("ts_ns"))
    return asof.lateness(q, ["symbol"], "ts_ns", "arrival", 1_800_000_000_000).select("symbol", "arrival", "ts_ns", "late")


@query(BASE + ", t AS (SELECT venue, ts_ns, state, lag(state) OVER (PARTITION BY venue ORDER BY ts_ns, arrival) AS p FROM q) SELECT venue, ts_ns FROM t WHERE state = 'down' AND p = 'up'")
def venue_downs(spark, sf):
    """The moments that evict a venue's leg."""
    t = scorecard.transitions(quotes(spark, sf).select("venue", "ts_ns", "arrival", "state"), ["venue"], "ts_ns", "arrival")
    return t.where("is_transition and state = 'down'").select("venue", "ts_ns")
