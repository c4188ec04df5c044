"""The reference operators as queries over the driver's tables, each with its twin in DuckDB's SQL.

``events`` stands in for a market feed: prices are whole millionths, so that both engines
compute on whole numbers and divide once at the end. Every query reads its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaymark.operators import asof, features, metrics, quantiles, research, scorecard
from quaymark.sources import wire
from quaymark.streaming import gateway

H = 3_600_000_000_000
AGE = 6 * H
MINUTE = H // 60
VENUES = ["click", "error", "purchase", "signup", "view"]
SYMBOLS = ["AAA-USD", "AAA-USDT", "BBB-USD", "BBB-USDT"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

BASE = """WITH e AS (SELECT event_id, epoch_us(ts) * 1000 AS ts_ns, user_id, event_type AS venue, CAST(round(value * 100) AS BIGINT) AS cents,
  CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events),
q AS (SELECT ['AAA-USD','AAA-USDT','BBB-USD','BBB-USDT'][(user_id % 4) + 1] AS symbol, venue, ts_ns, event_id AS arrival, user_id, k,
  1000000000 + cents * 2 - 10000 - 500 * k AS bid, 1000000000 + cents * 2 + 10000 + 500 * k AS ask, 1000000000 + cents * 2 AS price, k + 1 AS size,
  CASE WHEN k % 2 = 0 THEN 'bid' ELSE 'ask' END AS side, CASE WHEN k < 5 THEN 'down' ELSE 'up' END AS state FROM e)
"""
H_SQL = str(H)


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f
    return add


def quotes(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("long")
    cents = F.round(F.col("value") * 100).cast("long")
    e = e.select(F.col("event_id").alias("arrival"), (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("ts_ns"), "user_id",
        F.col("event_type").alias("venue"), cents.alias("cents"), k.alias("k"))
    mid, half = F.lit(1_000_000_000).cast("long") + F.col("cents") * 2, F.lit(10_000) + F.col("k") * 500
    return e.select(F.get(F.array(*[F.lit(s) for s in SYMBOLS]), (F.col("user_id") % 4).cast("int")).alias("symbol"), "venue", "ts_ns",
        "arrival", "user_id", "k", (mid - half).alias("bid"), (mid + half).alias("ask"),
                    mid.alias("price"), (F.col("k") + 1).alias("size"), F.when(F.col("k") % 2 == 0, "bid").otherwise("ask").alias("side"),
                    F.when(F.col("k") < 5, "down").otherwise("up").alias("state"))


def _nbbo_sql(age: int | None, downs: bool, out: str, truncated: bool = False) -> str:
    """NBBO in SQL: per venue the last event so far, then the best of the live ones."""
    ts = f"(ts_ns // {H}) * {H}" if truncated else "ts_ns"
    ev = f"SELECT symbol, venue, {ts} AS ts_ns, 0 AS late, arrival, true AS alive, bid, ask FROM q"
    if downs:
        ev += " UNION ALL SELECT s.symbol, d.venue, d.ts_ns, 1, 0, false, NULL, NULL FROM (SELECT DISTINCT symbol, venue FROM q) s JOIN downs d ON d.venue = s.venue"
    legs = ", ".join(f"last_value(CASE WHEN venue = '{v}' THEN {{'alive': alive, 'seen': ts_ns, 'bid': bid, 'ask': ask}} END IGNORE NULLS) OVER w AS v{i}" for i, v in enumerate(VENUES))
    rows = " UNION ALL ".join(f"SELECT symbol, ts_ns, '{v}' AS venue, v{i}.alive AS alive, v{i}.seen AS seen, v{i}.bid AS bid, v{i}.ask AS ask FROM ticks" for i, v in enumerate(VENUES))
    cond = "alive" + (f" AND ts_ns - seen <= {age}" if age is not None else "")
    extra = ", tr AS (SELECT venue, ts_ns, state, lag(state) OVER (PARTITION BY venue ORDER BY ts_ns, arrival) AS prev FROM q), downs AS (SELECT venue, ts_ns FROM tr WHERE state = 'down' AND prev = 'up')" if downs else ""
    return BASE + extra + f""", ev AS ({ev}),
run AS (SELECT symbol, ts_ns, lead(ts_ns) OVER (PARTITION BY symbol ORDER BY ts_ns, late, arrival) AS nxt, {legs} FROM ev WINDOW w AS (PARTITION BY symbol ORDER BY ts_ns, late, arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ticks AS (SELECT * FROM run WHERE nxt IS NULL OR nxt <> ts_ns),
live AS (SELECT * FROM ({rows}) WHERE {cond}),
nbbo AS (SELECT symbol, ts_ns, max(bid) AS best_bid, min(ask) AS best_ask, max({{'p': bid, 'v': venue}}).v AS bid_venue, min({{'p': ask, 'v': venue}}).v AS ask_venue, count(*) AS n_venues FROM live GROUP BY ALL)
{out}"""


def _downs(q: DataFrame) -> DataFrame:
    t = scorecard.transitions(q.select("venue", "ts_ns", "arrival", "state"), ["venue"], "ts_ns", "arrival")
    return t.where("is_transition and state = 'down'").select("venue", "ts_ns")


@query(_nbbo_sql(None, False, "SELECT * FROM nbbo"))
def nbbo_asof(spark, sf):
    return asof.nbbo(quotes(spark, sf), VENUES, None, shard_ns=4 * AGE)


@query(_nbbo_sql(AGE, False, "SELECT * FROM nbbo"))
def nbbo_evict_stale(spark, sf):
    return asof.nbbo(quotes(spark, sf), VENUES, AGE, shard_ns=2 * AGE)


@query(_nbbo_sql(AGE, False, "SELECT * FROM nbbo", truncated=True))
def nbbo_ties(spark, sf):
    return asof.nbbo(quotes(spark, sf).withColumn("ts_ns", F.expr(f"(ts_ns div {H}) * {H}")), VENUES, AGE, shard_ns=2 * AGE)


@query(_nbbo_sql(AGE, True, "SELECT * FROM nbbo"))
def nbbo_evict_down(spark, sf):
    q = quotes(spark, sf)
    return asof.nbbo(q, VENUES, AGE, _downs(q), shard_ns=2 * AGE)


_BASIS = """, legs AS (SELECT split_part(symbol, '-', 1) AS base, split_part(symbol, '-', 2) AS quote, ts_ns, best_bid + best_ask AS mid2 FROM nbbo),
br AS (SELECT base, ts_ns, lead(ts_ns) OVER (PARTITION BY base ORDER BY ts_ns) AS nxt, last_value(CASE WHEN quote = 'USD' THEN {'seen': ts_ns, 'm': mid2} END IGNORE NULLS) OVER w AS u,
  last_value(CASE WHEN quote = 'USDT' THEN {'seen': ts_ns, 'm': mid2} END IGNORE NULLS) OVER w AS t FROM legs WINDOW w AS (PARTITION BY base ORDER BY ts_ns ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
basis AS (SELECT base, ts_ns, u.m AS usd_mid2, t.m AS usdt_mid2, u.m - t.m AS basis2, CAST(u.m - t.m AS DOUBLE) / u.m * 10000.0 AS basis_bps FROM br WHERE (nxt IS NULL OR nxt <> ts_ns) AND u IS NOT NULL AND t IS NOT NULL AND ts_ns - u.seen <= %d AND ts_ns - t.seen <= %d)
""" % (AGE, AGE)


def _instruments(spark):
    rows = [(s, s.split("-")[0], s.split("-")[1], v, s) for s in SYMBOLS for v in VENUES]
    return spark.createDataFrame(rows, "canonical string, base string, quote string, exchange string, symbol string")


@query(_nbbo_sql(AGE, False, _BASIS + "SELECT * FROM basis"))
def basis_cross_quote(spark, sf):
    return asof.basis(nbbo_evict_stale(spark, sf), wire.pairs_by_base(_instruments(spark)), AGE)


def summary(basis: DataFrame) -> DataFrame:
    """Daily basis statistics: exact percentiles, population deviation, rounded to a millionth."""
    b = F.col("basis_bps")
    dated = basis.withColumn("date", F.date_format(F.timestamp_micros(F.expr("ts_ns div 1000")), "yyyy-MM-dd"))
    out = dated.groupBy("base", "date").agg(F.count("*").alias("n_obs"), F.avg(b).alias("mean"), F.stddev_pop(b).alias("std"),
        F.min(b).alias("lo"), F.max(b).alias("hi"), (F.max("ts_ns") - F.min("ts_ns")).alias("coverage_ns"))
    out = out.join(quantiles.percentiles(dated, ["base", "date"], "basis_bps", [0.5, 0.01, 0.99]), ["base", "date"])
    r = lambda c: F.round(c, 6)
    return out.select("base", "date", "n_obs", r("mean").alias("basis_bps_mean"), r("std").alias("basis_bps_std"),
        r(F.col("p")[0]).alias("basis_bps_median"), r("lo").alias("basis_bps_min"), r("hi").alias("basis_bps_max"),
                      r(F.col("p")[1]).alias("basis_bps_p1"), r(F.col("p")[2]).alias("basis_bps_p99"), "coverage_ns")


@query(_nbbo_sql(AGE, False, _BASIS + """SELECT base, strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d') AS date, count(*) AS n_obs, round(avg(basis_bps), 6) AS basis_bps_mean, round(stddev_pop(basis_bps), 6) AS basis_bps_std,
round(quantile_cont(basis_bps, 0.5), 6) AS basis_bps_median, round(min(basis_bps), 6) AS basis_bps_min, round(max(basis_bps), 6) AS basis_bps_max, round(quantile_cont(basis_bps, 0.01), 6) AS basis_bps_p1,
round(quantile_cont(basis_bps, 0.99), 6) AS basis_bps_p99, max(ts_ns) - min(ts_ns) AS coverage_ns FROM basis GROUP BY ALL"""))
def basis_summary(spark, sf):
    return summary(basis_cross_quote(spark, sf))


_GRID = f""", g AS (SELECT symbol, venue, unnest(range(((min(ts_ns) + {H - 1}) // {H}) * {H}, ((max(ts_ns) + {H - 1}) // {H}) * {H} + 1, {H})) AS ts_ns FROM q GROUP BY symbol, venue),
gq AS (SELECT g.symbol, g.venue, g.ts_ns, q.bid, q.ask, g.ts_ns - q.ts_ns AS age_ns FROM g ASOF LEFT JOIN q ON g.symbol = q.symbol AND g.venue = q.venue AND g.ts_ns >= q.ts_ns)
"""


def gridded(spark, sf):
    q = quotes(spark, sf)
    return asof.asof_join(features.grid(q, ["symbol", "venue"], "ts_ns", H), q, ["symbol", "venue"], "ts_ns", ["arrival"], ["bid", "ask"],
        shard_ns=4 * AGE)


@query(BASE + _GRID + "SELECT * FROM gq")
def asof_grid_age(spark, sf):
    return gridded(spark, sf)


_TR = """, tr AS (SELECT venue, ts_ns, arrival, state, lag(state) OVER w AS prev_state, lag(ts_ns) OVER w AS pts FROM q WINDOW w AS (PARTITION BY venue ORDER BY ts_ns, arrival)),
st AS (SELECT venue, ts_ns, arrival, state, prev_state, coalesce(prev_state <> state, false) AS is_transition, CASE WHEN prev_state = 'down' AND state = 'up' THEN ts_ns - pts END AS downtime_ns FROM tr)
"""


@query(BASE + _TR + "SELECT * FROM st")
def status_transitions(spark, sf):
    return scorecard.transitions(quotes(spark, sf).select("venue", "ts_ns", "arrival", "state"), ["venue"], "ts_ns", "arrival")


@query(BASE + _TR + "SELECT venue, count_if(is_transition) AS transitions, count_if(is_transition AND state = 'down') AS n_violations, CAST(sum(coalesce(downtime_ns, 0)) AS BIGINT) AS downtime_ns, arg_max(state, {'t': ts_ns, 'a': arrival}) AS final_state FROM st GROUP BY venue")
def scorecard_uptime(spark, sf):
    return scorecard.uptime(status_transitions(spark, sf), ["venue"], "ts_ns", "arrival")


@query("""SELECT l_returnflag AS dataset, count(*) AS n_records, quantile_cont(v, 0.5) AS p50_ms, quantile_cont(v, 0.95) AS p95_ms, quantile_cont(v, 0.99) AS p99_ms, max(v) AS max_ms
FROM (SELECT l_returnflag, CAST(CAST(l_quantity * 1000000 AS BIGINT) AS DOUBLE) / 1000000.0 AS v FROM lineitem) GROUP BY 1""")
def latency_percentiles(spark, sf):
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_returnflag").alias("dataset"),
        (F.col("l_quantity") * 1_000_000).cast("long").alias("ns"))
    return scorecard.latency(rows, ["dataset"], "ns")


_SEQ = """, s AS (SELECT symbol, venue, ts_ns, arrival, user_id, k, bid, ask, arrival - lag(arrival) OVER (PARTITION BY symbol, venue ORDER BY arrival) - 1 AS gap FROM q)
"""


def _sequenced(spark, sf):
    w = Window.partitionBy("symbol", "venue").orderBy("arrival")
    return quotes(spark, sf).withColumn("seq_gap", F.col("arrival") - F.lag("arrival").over(w) - 1)


@query(BASE + _SEQ + "SELECT symbol, venue, count(*) AS n_records, count_if(gap > 0) AS n_violations, CAST(sum(gap) AS BIGINT) AS total_missing, max(gap) AS max_gap FROM s WHERE gap IS NOT NULL GROUP BY ALL")
def scorecard_gap(spark, sf):
    return scorecard.sequence_gap(_sequenced(spark, sf).where("seq_gap is not null"), ["symbol", "venue"])


@query(BASE + "SELECT symbol, venue, count(*) AS n_records, count_if(k > 95) AS n_violations, count_if(k > 90) AS n_crossed, count_if(k > 90 AND k % 2 = 0) AS n_locked FROM q GROUP BY ALL")
def scorecard_invariant(spark, sf):
    q = quotes(spark, sf).select("symbol", "venue", F.when(F.col("k") > 95, "crossed_after_delta").alias("invariant_kind"),
        (F.col("k") > 90).alias("crossed"), (F.col("k") % 2 == 0).alias("locked"))
    return scorecard.invariants(q, ["symbol", "venue"])


@query(BASE + f""", r AS (SELECT venue, arrival, arrival // 1000 AS epoch, CASE WHEN k <> 7 THEN ts_ns - k * 20000000000 END AS recv FROM q),
l AS (SELECT *, lag(recv) OVER w AS pr, lag(epoch) OVER w AS pe FROM r WHERE recv IS NOT NULL WINDOW w AS (PARTITION BY venue ORDER BY arrival)),
c AS (SELECT venue, count_if(recv < pr AND pe = epoch) AS n_violations, count_if(recv < pr AND pe <> epoch) AS inter_epoch_steps, coalesce(max(CASE WHEN recv < pr AND pe = epoch THEN pr - recv END), 0) AS worst_ns FROM l GROUP BY venue)
SELECT n.venue, n_records, n_violations, inter_epoch_steps, worst_ns FROM (SELECT venue, count(*) AS n_records FROM r GROUP BY venue) n JOIN c USING (venue)""")
def scorecard_clock(spark, sf):
    q = quotes(spark, sf).select("venue", "arrival", F.expr("arrival div 1000").alias("epoch"),
        F.when(F.col("k") != 7, F.col("ts_ns") - F.col("k") * 20_000_000_000).alias("recv"))
    return scorecard.clock(q, ["venue"], ["arrival"], "recv", "epoch")


@query(BASE + """SELECT x.symbol, x.venue, 'coverage' AS "check", CAST(0 AS BIGINT) AS n_records, CAST(1 AS BIGINT) AS n_violations FROM (SELECT unnest(['AAA-USD','AAA-USDT','BBB-USD','BBB-USDT']) AS symbol) s,
LATERAL (SELECT s.symbol, unnest(['click','error','purchase','signup','view','idle']) AS venue) x WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.symbol = x.symbol AND q.venue = x.venue)""")
def scorecard_absent(spark, sf):
    expected = spark.createDataFrame([(s, v) for s in SYMBOLS for v in [*VENUES, "idle"]], "symbol string, venue string")
    return scorecard.absent(quotes(spark, sf), expected, ["symbol", "venue"])


BUDGET = {"default": {"max_violations": 0},
    "checks": {"sequence_gap": {"max_violations": 3, "max_rate": 0.9,
    "exchanges": {"view": {"max_violations": 1, "symbols": {"AAA-USD": {"max_violations": 1000000}}}}}}}


@query(BASE + _SEQ + """, c AS (SELECT venue AS exchange, symbol, strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d') AS date, count(*) AS n, count_if(gap > 0) AS v FROM s WHERE gap IS NOT NULL GROUP BY 1, 2, 3),
l AS (SELECT *, CASE WHEN exchange = 'view' AND symbol = 'AAA-USD' THEN 1000000.0 WHEN exchange = 'view' THEN 1.0 ELSE 3.0 END AS mv FROM c)
SELECT exchange, symbol, date, 'sequence_gap' AS "check", 'max_violations' AS "limit", CAST(v AS DOUBLE) AS value, CAST(mv AS DOUBLE) AS bound FROM l WHERE v > mv
UNION ALL SELECT exchange, symbol, date, 'sequence_gap', 'max_rate', CAST(v AS DOUBLE) / n, CAST(0.9 AS DOUBLE) FROM l WHERE n > 0 AND CAST(v AS DOUBLE) / n > 0.9""")
def budget_breaches(spark, sf):
    rows = scorecard.sequence_gap(_sequenced(spark, sf).where("seq_gap is not null").withColumn("date",
        F.date_format(F.timestamp_micros(F.expr("ts_ns div 1000")), "yyyy-MM-dd")), ["symbol", "venue", "date"])
    rows = rows.select(F.col("venue").alias("exchange"), "symbol", "date", F.lit("sequence_gap").alias("check"), "n_records",
        "n_violations", F.lit(None).cast("double").alias("p99_ms"))
    return scorecard.breaches(rows, scorecard.rules_frame(spark, BUDGET))


_FLOW = f""", f AS (SELECT symbol, ((ts_ns + {H - 1}) // {H}) * {H} AS ts_ns, CAST(sum(CASE WHEN side = 'bid' THEN size ELSE -size END) AS BIGINT) AS signed_vol, CAST(sum(size) AS BIGINT) AS volume, count(*) AS n_trades, CAST(sum(price * size) AS BIGINT) AS notional FROM q GROUP BY ALL)
"""


@query(BASE + _FLOW + "SELECT *, CAST(notional AS DOUBLE) / volume AS vwap FROM f")
def bar_flow(spark, sf):
    return features.flow(quotes(spark, sf), ["symbol"], "ts_ns", H)


@query(BASE + _FLOW + "SELECT symbol, ts_ns, CAST(notional AS DOUBLE) / volume AS vwap FROM f")
def bar_vwap(spark, sf):
    return bar_flow(spark, sf).select("symbol", "ts_ns", "vwap")


_OFI = f""", o AS (SELECT symbol, venue, ts_ns, arrival, CASE WHEN ts_ns - lag(ts_ns) OVER w <= {AGE} THEN
 (CASE WHEN bid > lag(bid) OVER w THEN size WHEN bid = lag(bid) OVER w THEN size - lag(size) OVER w ELSE -lag(size) OVER w END) -
 (CASE WHEN ask < lag(ask) OVER w THEN size WHEN ask = lag(ask) OVER w THEN size - lag(size) OVER w ELSE -lag(size) OVER w END) ELSE 0 END AS ofi FROM q WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns, arrival))
"""


def _ofi(spark, sf):
    q = quotes(spark, sf).withColumn("bid_sz", F.col("size")).withColumn("ask_sz", F.col("size"))
    return features.ofi(q, ["symbol", "venue"], "ts_ns", "arrival", AGE)


@query(BASE + _OFI + f"SELECT symbol, venue, ((ts_ns + {H - 1}) // {H}) * {H} AS ts_ns, CAST(sum(ofi) AS BIGINT) AS ofi FROM o GROUP BY ALL")
def ofi_bar(spark, sf):
    return _ofi(spark, sf).groupBy("symbol", "venue", features.bar("ts_ns", H).alias("ts_ns")).agg(F.sum("ofi").alias("ofi"))


_GF = f""", gs AS (SELECT symbol, unnest(range(((min(ts_ns) + {H - 1}) // {H}) * {H}, ((max(ts_ns) + {H - 1}) // {H}) * {H} + 1, {H})) AS ts_ns FROM q GROUP BY symbol),
gf AS (SELECT gs.symbol, gs.ts_ns, f.signed_vol FROM gs LEFT JOIN f ON f.symbol = gs.symbol AND f.ts_ns = gs.ts_ns)
"""


@query(BASE + _FLOW + _GF + "SELECT symbol, ts_ns, CAST(CASE WHEN count(signed_vol) OVER w = 5 THEN sum(signed_vol) OVER w END AS BIGINT) AS signed_vol_5 FROM gf WINDOW w AS (PARTITION BY symbol ORDER BY ts_ns ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)")
def rolling_flow(spark, sf):
    q = quotes(spark, sf)
    g = features.grid(q, ["symbol"], "ts_ns", H).join(features.flow(q, ["symbol"], "ts_ns", H), ["symbol", "ts_ns"], "left")
    return g.select("symbol", "ts_ns", features.rolling("signed_vol", Window.partitionBy("symbol").orderBy("ts_ns"),
        5).alias("signed_vol_5"))


def _ret_sql(op: str, sign: int) -> str:
    then = "CASE WHEN {o}(age_ns, {k}) OVER w <= %d THEN {o}(mid, {k}) OVER w END" % (2 * H)
    cols = []
    for k in (1, 5):
        t = then.format(o=op, k=k)
        cols.append(f"(now / ({t}) - 1) * 10000.0 AS r_{k}" if sign < 0 else f"(({t}) / now - 1) * 10000.0 AS r_{k}")
    return BASE + _GRID + f", m AS (SELECT symbol, venue, ts_ns, age_ns, CAST(bid + ask AS DOUBLE) AS mid, CASE WHEN age_ns <= {2 * H} THEN CAST(bid + ask AS DOUBLE) END AS now FROM gq) SELECT symbol, venue, ts_ns, {', '.join(cols)} FROM m WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns)"


def _returns(spark, sf, sign):
    g = gridded(spark, sf).withColumn("mid", (F.col("bid") + F.col("ask")).cast("double"))
    w = Window.partitionBy("symbol", "venue").orderBy("ts_ns")
    return g.select("symbol", "venue", "ts_ns",
        *[features.returns_bps("mid", "age_ns", w, sign * k, 2 * H).alias(f"r_{k}") for k in (1, 5)])


@query(_ret_sql("lag", -1))
def trailing_returns(spark, sf):
    return _returns(spark, sf, -1)


@query(_ret_sql("lead", 1))
def forward_targets(spark, sf):
    return _returns(spark, sf, 1)


@query(_ret_sql("lead", 1).replace("SELECT symbol, venue, ts_ns, (",
    "SELECT symbol, venue, ts_ns, CAST(CASE WHEN r_1 IS NULL THEN NULL WHEN r_1 > 0.5 * sp THEN 1 WHEN r_1 < -0.5 * sp THEN -1 ELSE 0 END AS TINYINT) AS y FROM (SELECT symbol, venue, ts_ns, CAST(ask - bid AS DOUBLE) / (CAST(bid + ask AS DOUBLE) / 2) * 10000.0 AS sp, (", 1).replace("age_ns, CAST(bid + ask AS DOUBLE) AS mid", "age_ns, bid, ask, CAST(bid + ask AS DOUBLE) AS mid") + ")")
def dead_zone(spark, sf):
    g = gridded(spark, sf).withColumn("mid", (F.col("bid") + F.col("ask")).cast("double"))
    w = Window.partitionBy("symbol", "venue").orderBy("ts_ns")
    spread = (F.col("ask") - F.col("bid")).cast("double") / (F.col("mid") / 2) * 1e4
    return g.select("symbol", "venue", "ts_ns", features.returns_bps("mid", "age_ns", w, 1, 2 * H).alias("r"),
        spread.alias("sp")).select("symbol", "venue", "ts_ns", features.dead_zone(F.col("r"), F.col("sp")).alias("y"))


@query(BASE + "SELECT arrival, CAST(size - (100 - k) AS DOUBLE) / (size + (100 - k)) AS imbalance FROM q")
def book_imbalance(spark, sf):
    return quotes(spark, sf).select("arrival", features.imbalance(F.col("size"), 100 - F.col("k")).alias("imbalance"))


@query(BASE + "SELECT arrival, round((CAST(bid * (100 - k) + ask * size AS DOUBLE) / (size + 100 - k) - CAST(bid + ask AS DOUBLE) / 2) / (CAST(bid + ask AS DOUBLE) / 2) * 10000.0, 6) AS micro_dev FROM q")
def microprice(spark, sf):
    return quotes(spark, sf).select("arrival", F.round(features.microprice_dev(F.col("bid"), F.col("ask"), F.col("size"), 100 - F.col("k")),
        6).alias("micro_dev"))


@query(BASE + ", l AS (SELECT symbol, user_id % 2 AS side, cents // 100 AS px, arg_max(e.k, arrival) AS sz FROM q JOIN e ON e.event_id = q.arrival GROUP BY ALL) SELECT symbol, side, px, sz FROM l WHERE sz > 0".replace("user_id % 2 AS side", "q.user_id % 2 AS side"))
def l2_state_asof(spark, sf):
    q = quotes(spark, sf).withColumn("px", F.expr("((price - 1000000000) div 2) div 100")).withColumn("s", F.col("user_id") % 2)
    return q.groupBy("symbol", F.col("s").alias("side"), "px").agg(F.max_by("k", "arrival").alias("sz")).where("sz > 0")


_L2 = ", l AS (SELECT q.symbol, q.user_id % 2 AS side, cents // 100 AS px, arg_max(e.k, arrival) AS sz FROM q JOIN e ON e.event_id = q.arrival GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY symbol, side ORDER BY CASE WHEN side = 0 THEN -px ELSE px END) AS rn FROM l WHERE sz > 0)"


@query(BASE + _L2 + " SELECT symbol, side, CAST(sum(sz) FILTER (rn <= 5) AS BIGINT) AS depth_5, CAST(sum(sz) FILTER (rn <= 10) AS BIGINT) AS depth_10, arg_max(px, rn) FILTER (rn <= 10) AS px_10 FROM n GROUP BY ALL")
def depth_rungs(spark, sf):
    w = Window.partitionBy("symbol", "side").orderBy(F.when(F.col("side") == 0, -F.col("px")).otherwise(F.col("px")))
    n = l2_state_asof(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 10")
    return n.groupBy("symbol", "side").agg(F.sum(F.when(F.col("rn") <= 5, F.col("sz"))).alias("depth_5"), F.sum("sz").alias("depth_10"),
        F.max_by("px", "rn").alias("px_10"))


@query(BASE + ", b AS (SELECT symbol, venue, ts_ns, arrival, k // 20 AS lvl, lag(k // 20) OVER (PARTITION BY symbol, venue ORDER BY ts_ns, arrival) AS p FROM q) SELECT symbol, venue, ts_ns, arrival, lvl FROM b WHERE p IS NULL OR p <> lvl")
def bbo_dedup(spark, sf):
    q = quotes(spark, sf).select("symbol", "venue", "ts_ns", "arrival", F.expr("k div 20").alias("lvl"))
    return gateway.changed(q, ["symbol", "venue"], ["ts_ns", "arrival"], ["lvl"])


@query(_nbbo_sql(AGE, False, ", d AS (SELECT *, lag({'b': best_bid, 'a': best_ask}) OVER (PARTITION BY symbol ORDER BY ts_ns) AS p FROM nbbo) SELECT symbol, ts_ns, best_bid, best_ask FROM d WHERE p IS NULL OR p.b <> best_bid OR p.a <> best_ask"))
def nbbo_dedup(spark, sf):
    return gateway.changed(nbbo_evict_stale(spark, sf), ["symbol"], ["ts_ns"], ["best_bid", "best_ask"]).select("symbol", "ts_ns",
        "best_bid", "best_ask")


@query(BASE + "SELECT symbol, arrival, max(ts_ns - k * 1000000000000) OVER (PARTITION BY symbol ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS clock FROM q")
def stream_clock(spark, sf):
    q = quotes(spark, sf).withColumn("ts_ns", F.col("ts_ns") - F.col("k") * 1_000_000_000_000)
    return gateway.stream_clock(q, "ts_ns", "arrival", ["symbol"]).select("symbol", "arrival", "clock")


@query(BASE + f"SELECT venue, symbol, max(ts_ns) AS last_ns, (SELECT max(ts_ns) FROM q) - max(ts_ns) > {H} AS evicted FROM q GROUP BY ALL")
def liveness_evict(spark, sf):
    q = quotes(spark, sf)
    now = q.agg(F.max("ts_ns").alias("now"))
    return q.groupBy("venue", "symbol").agg(F.max("ts_ns").alias("last_ns")).join(F.broadcast(now), F.lit(True)).select("venue", "symbol",
        "last_ns", (F.col("now") - F.col("last_ns") > H).alias("evicted"))


@query(BASE + ", r AS (SELECT symbol, arrival, ts_ns - (k % 3) * 600000000000 AS ts_ns FROM q) SELECT symbol, arrival, ts_ns, CAST(row_number() OVER (PARTITION BY symbol ORDER BY ts_ns, arrival) AS INTEGER) AS position FROM r")
def reorder_lateness(spark, sf):
    q = quotes(spark, sf).select("symbol", "arrival", (F.col("ts_ns") - (F.col("k") % 3) * 600_000_000_000).alias("ts_ns"))
    return asof.reorder(q, ["symbol"], "ts_ns", "arrival", 1_800_000_000_000)


@query(BASE + "SELECT symbol, venue, max(arrival) AS arrival, arg_max(bid, arrival) AS bid, arg_max(ask, arrival) AS ask FROM q GROUP BY ALL")
def compact_latest(spark, sf):
    return gateway.compact(quotes(spark, sf).select("symbol", "venue", "arrival", "bid", "ask"), ["symbol", "venue"],
        "arrival").select("symbol", "venue", "arrival", "bid", "ask")


@query(BASE + "SELECT arrival, CASE WHEN symbol LIKE 'AAA%' AND venue <> 'error' THEN 'X:' || symbol ELSE replace(symbol, '/', '-') END AS canonical FROM q")
def canonical_resolve(spark, sf):
    ref = spark.createDataFrame([("X:" + s, "AAA", "", v, s) for s in SYMBOLS if s.startswith("AAA") for v in VENUES if v != "error"],
        "canonical string, base string, quote string, exchange string, symbol string")
    return wire.resolve(quotes(spark, sf).withColumn("exchange", F.col("venue")), ref).select("arrival", "canonical")


@query("SELECT * FROM (VALUES ('AAA', 'AAA-USD', 'AAA-USDT'), ('BBB', 'BBB-USD', 'BBB-USDT')) t(base, usd, usdt)")
def pairs_by_base(spark, sf):
    return wire.pairs_by_base(_instruments(spark))


_DATE = "strftime(make_timestamp(ts_ns // 1000), '%Y-%m-%d')"


def _dated(spark, sf):
    return quotes(spark, sf).withColumn("date", F.date_format(F.timestamp_micros(F.expr("ts_ns div 1000")), "yyyy-MM-dd"))


@query(BASE + f"SELECT {_DATE} AS date, ts_ns, arrival, lead(k, 3) OVER (PARTITION BY {_DATE} ORDER BY ts_ns) AS k FROM q")
def placebo_shift(spark, sf):
    return research.placebo(_dated(spark, sf).select("date", "ts_ns", "arrival", "k"), "k", 3, ["date"], "ts_ns")


@query(BASE + f", n AS (SELECT {_DATE} AS date, ts_ns, arrival, row_number() OVER (PARTITION BY {_DATE} ORDER BY ts_ns) AS rn FROM q) SELECT date, ts_ns, arrival FROM n WHERE (rn - 1) % 5 = 0")
def strided_rows(spark, sf):
    return research.strided(_dated(spark, sf).select("date", "ts_ns", "arrival"), 5, ["date"], "ts_ns")


@query(BASE + f", n AS (SELECT symbol, ts_ns, arrival, CASE WHEN ts_ns - lag(ts_ns) OVER w > {H} THEN 1 ELSE 0 END AS b FROM q WINDOW w AS (PARTITION BY symbol ORDER BY ts_ns)) SELECT symbol, ts_ns, arrival, CAST(sum(b) OVER (PARTITION BY symbol ORDER BY ts_ns ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS stretch FROM n")
def gaps_islands(spark, sf):
    return research.islands(quotes(spark, sf).select("symbol", "ts_ns", "arrival"), ["symbol"], "ts_ns", H)


def _scored(spark, sf):
    return _dated(spark, sf).select("date", "arrival", (F.col("k") - 50).cast("double").alias("y"),
        (F.col("user_id") % 101 - 50).cast("double").alias("p"))


_SC = f", z AS (SELECT {_DATE} AS date, arrival, CAST(k - 50 AS DOUBLE) AS y, CAST(user_id % 101 - 50 AS DOUBLE) AS p FROM q)"
_PS = _SC + ", ps AS (SELECT date, sum(y * y - (y - p) * (y - p)) AS r2_num, sum(y * y) AS r2_den, sum(CASE WHEN sign(y) * sign(p) > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS hit_num, sum(CASE WHEN y <> 0 AND p <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS hit_den, sum(y * sign(p)) AS gross_bps_num, sum(CASE WHEN p <> 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS gross_bps_den FROM z GROUP BY date)"


@query(BASE + _PS + " SELECT * FROM ps")
def bootstrap_partials(spark, sf):
    return research.partial_sums(_scored(spark, sf), ["date"])


@query(BASE + _PS + " SELECT sum(r2_num) / sum(r2_den) AS r2 FROM ps")
def metric_ratio_r2(spark, sf):
    return research.ratios(bootstrap_partials(spark, sf)).select("r2")


@query(BASE + _PS + " SELECT sum(hit_num) / sum(hit_den) AS hit, sum(gross_bps_num) / sum(gross_bps_den) AS gross_bps FROM ps")
def metric_hit_rate(spark, sf):
    return research.ratios(bootstrap_partials(spark, sf)).select("hit", "gross_bps")


@query(BASE + """, c AS (SELECT CASE WHEN k > 66 THEN 1 WHEN k < 33 THEN -1 ELSE 0 END AS y, CAST(user_id % 3 - 1 AS INTEGER) AS p FROM q) SELECT
count_if(y = 1 AND p = 1)::DOUBLE / count_if(p = 1) AS up_precision, count_if(y = 1 AND p = 1)::DOUBLE / count_if(y = 1) AS up_recall, count_if(y = 1) AS up_support,
count_if(y = -1 AND p = -1)::DOUBLE / count_if(p = -1) AS down_precision, count_if(y = -1 AND p = -1)::DOUBLE / count_if(y = -1) AS down_recall, count_if(y = -1) AS down_support,
avg((p <> 0)::INT::DOUBLE) AS traded_share, avg((y <> 0)::INT::DOUBLE) AS movable_share FROM c""")
def class_precision(spark, sf):
    return research.class_report(quotes(spark, sf).select(F.when(F.col("k") > 66, 1).when(F.col("k") < 33, -1).otherwise(0).alias("y"),
        (F.col("user_id") % 3 - 1).alias("p")))


@query(BASE + _SC + " SELECT arrival, p FROM z WHERE abs(p) > (SELECT quantile_cont(abs(p), 0.8) FROM z)")
def coverage_cut(spark, sf):
    return research.coverage_cut(_scored(spark, sf).select("arrival", "p"), "p", 0.2)


@query(BASE + _GRID + f"SELECT symbol, venue, ts_ns, round(ln(CAST(bid + ask AS DOUBLE)), 9) AS log_price FROM gq WHERE bid IS NOT NULL AND age_ns <= {AGE} AND (ts_ns // {H}) % 2 = 0")
def price_panel(spark, sf):
    g = gridded(spark, sf).where((F.col("age_ns") <= AGE) & (F.expr(f"(ts_ns div {H}) % 2") == 0))
    return g.select("symbol", "venue", "ts_ns", F.round(F.ln((F.col("bid") + F.col("ask")).cast("double")), 9).alias("log_price"))


@query(BASE + ", l AS (SELECT symbol, venue, arg_max(bid, arrival) AS bid FROM q GROUP BY ALL) SELECT symbol, "
    + ", ".join(f"max(bid) FILTER (venue = '{v}') AS \"{v}\"" for v in VENUES) + " FROM l GROUP BY symbol")
def venue_pivot(spark, sf):
    return compact_latest(spark, sf).groupBy("symbol").pivot("venue", VENUES).agg(F.max("bid"))


_CTR = f""", c AS (SELECT venue, ts_ns // 1000000000 AS ts, arrival, (arrival * 7) % 5000 AS v FROM q), st AS (SELECT venue, ts, v, lag(v) OVER (PARTITION BY venue ORDER BY ts) AS p FROM (SELECT venue, ts, max(v) AS v FROM c GROUP BY ALL)),
inc AS (SELECT venue, ts, v, CAST(sum(CASE WHEN p IS NULL THEN 0 WHEN v >= p THEN v - p ELSE v END) OVER (PARTITION BY venue ORDER BY ts RANGE BETWEEN 21599 PRECEDING AND CURRENT ROW) AS BIGINT) AS increase FROM st)"""


def _counter(spark, sf):
    return quotes(spark, sf).groupBy("venue",
        F.expr("ts_ns div 1000000000").alias("ts")).agg(F.max((F.col("arrival") * 7) % 5000).alias("v"))


@query(BASE + _CTR + " SELECT venue, ts, v, increase FROM inc")
def counter_rate(spark, sf):
    return metrics.increase(_counter(spark, sf), ["venue"], "ts", "v", 21600)


@query(BASE + _CTR + """, a AS (SELECT venue, ts, increase > 30000 AS active FROM inc), ed AS (SELECT *, CASE WHEN active <> lag(active) OVER w THEN 1 WHEN lag(active) OVER w IS NULL THEN 1 ELSE 0 END AS e FROM a WINDOW w AS (PARTITION BY venue ORDER BY ts)),
ru AS (SELECT *, sum(e) OVER (PARTITION BY venue ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r FROM ed) SELECT venue, ts, active, active AND ts - min(ts) OVER (PARTITION BY venue, r) >= 7200 AS firing FROM ru""")
def alert_for(spark, sf):
    return metrics.firing(counter_rate(spark, sf), ["venue"], "ts", F.col("increase") > 30000, 7200).select("venue", "ts", "active",
        "firing")


@query(BASE + """, b AS (SELECT venue, le, (SELECT count(*) FROM q x WHERE x.venue = v.venue AND x.k <= le) AS n FROM (SELECT DISTINCT venue FROM q) v, (SELECT unnest([10, 25, 50, 75, 100]) AS le) l),
w AS (SELECT *, max(n) OVER (PARTITION BY venue) * 0.9::DOUBLE AS t, coalesce(lag(n) OVER (PARTITION BY venue ORDER BY le), 0) AS n0, coalesce(lag(le) OVER (PARTITION BY venue ORDER BY le), 0) AS l0 FROM b),
f AS (SELECT venue, min({'le': le, 'n': n, 'n0': n0, 'l0': l0, 't': t}) AS h FROM w WHERE n >= t GROUP BY venue) SELECT venue, h.l0 + (h.le - h.l0) * ((h.t - h.n0) / (h.n - h.n0)) AS quantile FROM f""")
def histogram_quantile(spark, sf):
    q = quotes(spark, sf)
    tall = q.select("venue", F.explode(F.array(*[F.struct(F.lit(b).alias("le"), (F.col("k") <= b).cast("int").alias("in"))
        for b in (10, 25, 50, 75, 100)])).alias("b"))
    return metrics.histogram_quantile(tall.groupBy("venue", F.col("b.le").alias("le")).agg(F.sum("b.in").alias("n")), ["venue"], 0.9)


@query(BASE + "SELECT arrival, symbol, price, size, side FROM q ORDER BY ts_ns DESC, arrival DESC LIMIT 12")
def tape_last12(spark, sf):
    return quotes(spark, sf).orderBy(F.desc("ts_ns"), F.desc("arrival")).limit(12).select("arrival", "symbol", "price", "size", "side")


@query(None)
def bootstrap_intervals(spark, sf):
    return research.bootstrap(bootstrap_partials(spark, sf), "date")


@query(None)
def book_fold(spark, sf):
    """The order-book fold over events as deltas of one level each; an epoch is a day."""
    from quaymark.operators import book

    level = F.array(F.struct(F.col("bid").cast("string").alias("px"), F.col("k").cast("string").alias("sz")))
    other = F.array(F.struct(F.col("ask").cast("string").alias("px"), F.col("k").cast("string").alias("sz")))
    none = F.array().cast("array<struct<px:string,sz:string>>")
    q = _dated(spark, sf).select(F.col("venue").alias("exchange"), "symbol", "date", F.lit("delta").alias("kind"),
        F.col("arrival").alias("offset"), F.col("arrival").alias("sequence"), F.lit(0).cast("long").alias("epoch"), "ts_ns",
                                 F.when(F.col("side") == "bid", level).otherwise(none).alias("bids"),
                                 F.when(F.col("side") == "ask", other).otherwise(none).alias("asks"))
    return book.fold_books(q)


@query(None)
def vecm_shares(spark, sf):
    """Information shares of every symbol, pair of venues and date, on a grid of a minute without stale quotes."""
    q = quotes(spark, sf)
    g = asof.asof_join(features.grid(q, ["symbol", "venue"], "ts_ns", MINUTE), q, ["symbol", "venue"], "ts_ns", ["arrival"], ["bid", "ask"])
    fresh = g.where((F.col("age_ns") <= AGE) & F.col("bid").isNotNull())
    wide = fresh.groupBy("symbol", "ts_ns").pivot("venue", VENUES).agg(F.max(F.ln((F.col("bid") + F.col("ask")).cast("double"))))
    pairs = [F.struct(F.lit(x).alias("venue_a"), F.lit(y).alias("venue_b"), F.col(x).alias("a"), F.col(y).alias("b")) for i,
        x in enumerate(VENUES) for y in VENUES[i + 1 :]]
    date = F.date_format(F.timestamp_micros(F.expr("ts_ns div 1000")), "yyyy-MM-dd").alias("date")
    panel = wide.select("symbol", date, "ts_ns", F.explode(F.array(*pairs)).alias("p")).select("symbol", "date", "ts_ns",
        "p.*").where("a is not null and b is not null")
    return research.info_shares(panel, least=None, interval_ns=MINUTE, by=["symbol", "venue_a", "venue_b"])


@query(None)
def ridge_fit(spark, sf):
    q = quotes(spark, sf).select(F.col("k").cast("double").alias("x0"), F.col("user_id").cast("double").alias("x1"),
        (F.col("price") - 1_000_000_000).cast("double").alias("y"))
    beta, intercept = research.ridge(q, ["x0", "x1"], "y")
    return spark.createDataFrame([("x0", float(beta[0])), ("x1", float(beta[1])), ("intercept", intercept)], "term string, value double")
