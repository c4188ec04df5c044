"""Queries over features, folds, metrics and models, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from quaymark.operators import asof, features, grammar, research
from quaymark.plans.market import AGE, BASE, H, SYMBOLS, _dated, _GRID, gridded, nbbo_evict_stale, query, quotes, vecm_shares
from quaymark.plans.silver import DATE

#: A bar is an hour here; a leg may be two hours old, so that windows of 30 and 300 bars allow for 3 and 30 hours.
FLOOR = 2 * H


def _leg() -> WindowSpec:
    return Window.partitionBy("symbol", "venue").orderBy("ts_ns")


def _tol(w: int) -> int:
    return features.window_tolerance(w, FLOOR, H)


_MID = _GRID + ", m AS (SELECT symbol, venue, ts_ns, age_ns, bid, ask, CAST(bid + ask AS DOUBLE) / 2 AS mid FROM gq)"


def _mid(spark: SparkSession, sf: str) -> DataFrame:
    return gridded(spark, sf).withColumn("mid", (F.col("bid") + F.col("ask")).cast("double") / 2)


def _rounded(df: DataFrame, keys: list[str], cols: dict[str, Column], digits: int = 6) -> DataFrame:
    return df.select(*keys, *[v.alias(k) for k, v in cols.items()]).select(*keys,
        *[F.round(k, digits).alias(k) if "_dz_" not in k else F.col(k) for k in cols])


@query(BASE + _MID + "SELECT symbol, venue, ts_ns, "
    + ", ".join(f"round((mid / (CASE WHEN lag(age_ns, {w}) OVER w <= {_tol(w)} THEN lag(mid, {w}) OVER w END) - 1) * 10000.0, 6) AS ret_bps_{w}" for w in features.RETURN_WINDOWS)
       + " FROM m WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns)")
def return_windows(spark, sf):
    return _rounded(_mid(spark, sf), ["symbol", "venue", "ts_ns"], features.trailing("mid", "age_ns", _leg(), H, FLOOR))


_Y = ", ".join(f"((CASE WHEN lead(age_ns, {h}) OVER w <= {_tol(h)} THEN lead(mid, {h}) OVER w END) / mid - 1) * 10000.0 AS r{h}"
    for h in features.HORIZONS)
_DZ = ", ".join(f"round(r{h}, 6) AS y_ret_bps_{h}, CAST(CASE WHEN r{h} IS NULL OR sp IS NULL THEN NULL WHEN r{h} > sp * 0.5 THEN 1 WHEN r{h} < -(sp * 0.5) THEN -1 ELSE 0 END AS TINYINT) AS y_dz_{h}" for h in features.HORIZONS)


@query(BASE + _MID + f", y AS (SELECT *, CAST(ask - bid AS DOUBLE) / mid * 10000.0 AS sp, {_Y} FROM m WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns)) SELECT symbol, venue, ts_ns, {_DZ} FROM y")
def target_windows(spark, sf):
    m = _mid(spark, sf).withColumn("sp", (F.col("ask") - F.col("bid")).cast("double") / F.col("mid") * 1e4)
    return _rounded(m, ["symbol", "venue", "ts_ns"], features.targets("mid", "sp", "age_ns", _leg(), H, FLOOR))


_LIVE = _GRID + f""", b AS (SELECT symbol, venue, ((ts_ns + {H - 1}) // {H}) * {H} AS ts_ns, CAST(sum(CASE WHEN side = 'bid' THEN size ELSE -size END) AS BIGINT) AS signed_vol, CAST(sum(size) AS BIGINT) AS volume FROM q GROUP BY ALL),
fl AS (SELECT gq.symbol, gq.venue, gq.ts_ns, coalesce(signed_vol, 0) AS signed_vol, coalesce(volume, 0) AS volume, CASE WHEN age_ns IS NULL THEN NULL WHEN age_ns <= {5 * H} THEN 1 ELSE 0 END AS live FROM gq LEFT JOIN b USING (symbol, venue, ts_ns))
"""


def _rolled(col: str, w: int, name: str | None = None) -> str:
    f = f"OVER (PARTITION BY symbol, venue ORDER BY ts_ns ROWS BETWEEN {w - 1} PRECEDING AND CURRENT ROW)"
    return f"CAST(CASE WHEN count({col}) {f} = {w} AND count(live) {f} = {w} AND min(live) {f} = 1 THEN sum({col}) {f} END AS BIGINT) AS {name or col}_{w}"


def _flowing(spark: SparkSession, sf: str, per_bar: DataFrame, cols: list[str]) -> DataFrame:
    """A sum by bar on the grid, zero where nothing came, with the liveness of the leg's own quotes."""
    g = gridded(spark, sf).join(per_bar, ["symbol", "venue", "ts_ns"], "left")
    return g.select("symbol", "venue", "ts_ns", *[F.coalesce(c, F.lit(0)).alias(c) for c in cols], (F.col("age_ns") <= 5 * H).alias("live"))


@query(BASE + _LIVE + "SELECT symbol, venue, ts_ns, " + ", ".join(_rolled(c, w) for w in features.FLOW_WINDOWS
    for c in ("signed_vol", "volume")) + " FROM fl")
def flow_windows(spark, sf):
    bars = features.flow(quotes(spark, sf), ["symbol", "venue"], "ts_ns", H).select("symbol", "venue", "ts_ns", "signed_vol", "volume")
    g = _flowing(spark, sf, bars, ["signed_vol", "volume"])
    return g.select("symbol", "venue", "ts_ns", *[v.alias(k) for k,
        v in features.flow_windows(["signed_vol", "volume"], "live", _leg()).items()])


_LIQ = _GRID + f""", b AS (SELECT symbol, venue, ((ts_ns + {H - 1}) // {H}) * {H} AS ts_ns, CAST(sum(CASE WHEN side = 'bid' THEN k ELSE -k END) AS BIGINT) AS liq_flow, count(*) AS n_liqs FROM q WHERE k > 60 GROUP BY ALL),
fl AS (SELECT gq.symbol, gq.venue, gq.ts_ns, coalesce(liq_flow, 0) AS liq_flow, coalesce(n_liqs, 0) AS n_liqs, CASE WHEN age_ns IS NULL THEN NULL WHEN age_ns <= {5 * H} THEN 1 ELSE 0 END AS live FROM gq LEFT JOIN b USING (symbol, venue, ts_ns))
"""


@query(BASE + _LIQ + "SELECT symbol, venue, ts_ns, liq_flow, n_liqs, "
    + ", ".join(_rolled(c, w) for w in features.FLOW_WINDOWS for c in ("liq_flow", "n_liqs")) + " FROM fl")
def liq_windows(spark, sf):
    forced = quotes(spark, sf).where("k > 60").withColumn("filled_size", F.col("k"))
    g = _flowing(spark, sf, features.liquidations(forced, ["symbol", "venue"], "ts_ns", H), ["liq_flow", "n_liqs"])
    return g.select("symbol", "venue", "ts_ns", "liq_flow", "n_liqs",
        *[v.alias(k) for k, v in features.flow_windows(["liq_flow", "n_liqs"], "live", _leg()).items()])


_PERP = _GRID.replace("q.bid, q.ask,",
    "q.bid, q.ask, q.price, q.k, q.ts_ns AS seen_at,") + """, p AS (SELECT symbol, venue, ts_ns, age_ns, CASE WHEN bid > 0 THEN CAST(price - bid AS DOUBLE) / bid * 10000.0 END AS basis, CAST(k AS DOUBLE) AS level, k, seen_at FROM gq) """


def _perp(spark: SparkSession, sf: str) -> DataFrame:
    q = quotes(spark, sf).withColumn("at", F.col("ts_ns"))
    return asof.asof_join(features.grid(q, ["symbol", "venue"], "ts_ns", H), q, ["symbol", "venue"], "ts_ns", ["arrival"],
        ["price", "bid", "k", "at"])


@query(BASE + _PERP + f"SELECT symbol, venue, ts_ns, round(basis, 6) + 0.0::DOUBLE AS basis_bps, round(CAST(seen_at + {24 * H} - ts_ns AS DOUBLE) / 1000000000.0, 6) AS funding_in_s, " + ", ".join(
    f"round(basis - (CASE WHEN lag(age_ns, {w}) OVER w <= {_tol(w)} THEN lag(basis, {w}) OVER w END), 6) + 0.0::DOUBLE AS basis_chg_{w}"
    for w in features.FLOW_WINDOWS) + " FROM p WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns)")
def basis_windows(spark, sf):
    p = _perp(spark, sf).withColumn("basis", features.mark_basis(F.col("price"), F.col("bid")))
    cols = {"basis_bps": F.col("basis") + 0.0, "funding_in_s": features.funding_countdown(F.col("at") + 24 * H, F.col("ts_ns")),
        **features.basis_changes("basis", "age_ns", _leg(), H, FLOOR)}
    return _rounded(p, ["symbol", "venue", "ts_ns"], cols)


@query(BASE + _PERP + "SELECT symbol, venue, ts_ns, " + ", ".join(
    f"round(CASE WHEN (CASE WHEN lag(age_ns, {w}) OVER w <= {_tol(w)} THEN lag(level, {w}) OVER w END) > 0 THEN (level / lag(level, {w}) OVER w - 1) * 10000.0 END, 6) AS oi_chg_bps_{w}" for w in features.FLOW_WINDOWS)
       + " FROM p WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns)")
def oi_windows(spark, sf):
    p = _perp(spark, sf).withColumn("level", F.col("k").cast("double"))
    return _rounded(p, ["symbol", "venue", "ts_ns"], features.oi_changes("level", "age_ns", _leg(), H, FLOOR))


@query(BASE + """SELECT arrival, round(CAST(k - size AS DOUBLE) / (k + size), 9) AS depth_imb_5, round(CAST(k * 3 - size AS DOUBLE) / (k * 3 + size), 9) AS depth_imb_10,
  round((CAST(bid + ask AS DOUBLE) / 2 - (bid - 100 * k)) / (CAST(bid + ask AS DOUBLE) / 2) * 10000.0, 6) AS bid_span_bps, round((ask + 100 * size - CAST(bid + ask AS DOUBLE) / 2) / (CAST(bid + ask AS DOUBLE) / 2) * 10000.0, 6) AS ask_span_bps,
  k * 3 + size AS depth_10 FROM q""")
def depth_shape(spark, sf):
    q = quotes(spark, sf).select("arrival", "bid", "ask", F.col("k").alias("bid_depth_5"), F.col("size").alias("ask_depth_5"),
        (F.col("k") * 3).alias("bid_depth_10"), F.col("size").alias("ask_depth_10"),
                                 (F.col("bid") - F.col("k") * 100).alias("bid_px_10"),
                                 (F.col("ask") + F.col("size") * 100).alias("ask_px_10"))
    s = features.depth_shape(q.columns, (F.col("bid") + F.col("ask")) / 2)
    return q.select("arrival", *[F.round(s[f"depth_imb_{n}"], 9).alias(f"depth_imb_{n}") for n in (5, 10)],
        F.round(s["bid_span_bps"], 6).alias("bid_span_bps"), F.round(s["ask_span_bps"], 6).alias("ask_span_bps"),
        s["depth_10"].alias("depth_10"))


_PURE = "CASE venue WHEN 'click' THEN 'AAA-USD' WHEN 'error' THEN 'AAA-USD' ELSE 'AAA-USDT' END"


@query(BASE + f"SELECT DISTINCT replace(venue, '-', '_') AS prefix, symbol, venue AS exchange FROM (SELECT venue, {_PURE} AS symbol FROM q)")
def quote_legs(spark, sf):
    q = quotes(spark, sf).select(F.col("venue").alias("exchange"), F.expr(_PURE).alias("symbol"))
    return spark.createDataFrame(features.legs(q, ["AAA-USD", "AAA-USDT"]), "prefix string, symbol string, exchange string")


def matrix(spark: SparkSession, sf: str) -> DataFrame:
    """The feature matrix of one symbol on hourly bars, with two of its venues, all tapes, and legs of another symbol."""
    q = _dated(spark, sf).withColumnRenamed("venue", "exchange").withColumn("symbol",
        F.when(F.col("exchange") == "view", "AAA-USDT").otherwise("AAA-USD"))
    q = q.where(F.col("exchange").isin("click", "error", "view"))
    books = q.select("date", "exchange", "symbol", "ts_ns", "arrival", "bid", "ask", F.col("size").alias("bid_sz"),
        (F.col("k") + 2).alias("ask_sz"))
    best = nbbo_evict_stale(spark, sf).where("symbol = 'AAA-USD'").select(F.date_format(F.timestamp_micros(F.expr("ts_ns div 1000")),
        "yyyy-MM-dd").alias("date"), "ts_ns", F.col("best_bid").alias("bid"), F.col("best_ask").alias("ask"), "n_venues")
    trades = q.select("date", "exchange", "symbol", "ts_ns", "price", "size", "side")
    perp = q.where("exchange = 'view'")
    marks = perp.select("date", "exchange", "symbol", "ts_ns", F.col("price").alias("mark_price"), F.col("bid").alias("index_price"),
        F.col("k").alias("funding_rate"), (F.col("ts_ns") + 24 * H).alias("next_funding_ts_ns"))
    interest = perp.select("date", "exchange", "symbol", "ts_ns", F.col("size").alias("open_interest"))
    forced = perp.where("k > 50").select("date", "exchange", "symbol", "ts_ns", F.col("size").alias("filled_size"), "side")
    return features.feature_matrix(books, best, trades, "AAA-USD", ("AAA-USDT",), H, marks, interest, forced, max_age_ms=6 * 3_600_000,
        max_tape_age_ms=12 * 3_600_000)


@query(None)
def feature_matrix(spark, sf):
    return matrix(spark, sf)


@query(None)
def schema_audit(spark, sf):
    """Each column of the matrix with its family, role and venue, and whether it is there."""
    g = grammar.Grammar(c for c in matrix(spark, sf).columns if c != "click_vwap")
    return spark.createDataFrame([(c.name, c.family, c.role, c.venue, c.name in g.present) for c in g.columns.values()],
        "column string, family string, role string, venue string, present boolean")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select("date", "ts_ns", "arrival", "k", F.col("user_id").alias("u"))


@query(BASE + f""", r AS (SELECT {DATE} AS date, ts_ns, arrival FROM q), d AS (SELECT date, row_number() OVER (ORDER BY date) AS i FROM (SELECT DISTINCT date FROM r)),
t AS (SELECT r.*, row_number() OVER (ORDER BY ts_ns) AS place, count(*) OVER () - 5 AS kept FROM r JOIN d USING (date) WHERE i <= 8),
p AS (SELECT arrival, CASE WHEN place > kept THEN NULL WHEN place > kept - CAST(round_even(kept * 0.15, 0) AS BIGINT) THEN 'val' WHEN place <= kept - CAST(round_even(kept * 0.15, 0) AS BIGINT) - 5 THEN 'fit' END AS part FROM t)
SELECT arrival, part FROM p UNION ALL SELECT arrival, 'test' FROM r JOIN d USING (date) WHERE i BETWEEN 9 AND 11""")
def fold_parts(spark, sf):
    rows = _labelled(spark, sf)
    dates = [r[0] for r in rows.select("date").distinct().collect()]
    train, test = research.walk_forward(dates)[0]
    return research.fold_rows(rows, train, test, 5).select("arrival", "part")


_EV = f", z AS (SELECT {DATE} AS date, arrival, CAST(k - 50 AS DOUBLE) AS y, CAST(user_id % 7 - 3 AS DOUBLE) AS p, 20.0::DOUBLE + k % 9 AS threshold FROM q)"


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    return _dated(spark, sf).select("date", "arrival", (F.col("k") - 50).cast("double").alias("y"),
        (F.col("user_id") % 7 - 3).cast("double").alias("p"), (F.lit(20.0) + F.col("k") % 9).alias("threshold"))


@query(BASE + _EV + """SELECT date, count(*) AS n, round(1 - sum((y - p) * (y - p)) / nullif(sum(y * y), 0), 9) AS r2, round(sum(CASE WHEN y <> 0 AND sign(y) = sign(p) THEN 1.0::DOUBLE ELSE 0 END) / nullif(count_if(y <> 0 AND p <> 0), 0), 9) AS hit,
  round(CASE WHEN count(*) > 2 AND stddev_pop(p) > 0 AND stddev_pop(y) > 0 THEN corr(y, p) END, 9) AS corr, round(stddev_pop(p), 9) AS pred_std, round(stddev_pop(y), 9) AS y_std FROM z GROUP BY date""")
def evaluate_rows(spark, sf):
    out = research.evaluate(_predicted(spark, sf), ["date"])
    return out.select("date", "n", *[F.round(c, 9).alias(c) for c in ("r2", "hit", "corr", "pred_std", "y_std")])


@query(BASE + _EV + "SELECT date, count_if(p <> 0) AS n_trades, sum(CASE WHEN p <> 0 THEN sign(p) * y END) AS gross_bps_total, sum(CASE WHEN p <> 0 THEN sign(p) * y END) / nullif(count_if(p <> 0), 0) AS gross_bps_per_trade FROM z GROUP BY date")
def edge_by_date(spark, sf):
    return research.edge_summary(_predicted(spark, sf), ["date"])


@query(BASE + _EV + ", per AS (SELECT date, sum(y * p) AS v FROM z GROUP BY date) SELECT substr(date, 9, 1) AS decade, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std FROM per GROUP BY ALL")
def fold_spread(spark, sf):
    per = _predicted(spark, sf).groupBy("date").agg(F.sum(F.col("y") * F.col("p")).alias("v")).withColumn("decade",
        F.substring("date", 9, 1))
    return research.spread_over(per, ["decade"], "v").select("decade", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(BASE + _EV + """SELECT arrival, CAST(CASE WHEN abs(y) > threshold THEN sign(y) ELSE 0 END AS INTEGER) AS y, CAST(CASE WHEN abs(p) > (SELECT quantile_cont(abs(p), 0.7) FROM z) THEN sign(p) ELSE 0 END AS INTEGER) AS p FROM z""")
def classes_at_coverage(spark, sf):
    return research.as_classes(_predicted(spark, sf), share=0.3).select("arrival", "y", "p")


@query(None)
def metric_intervals(spark, sf):
    return research.intervals(_predicted(spark, sf), share=0.3, draws=200)


@query(None)
def share_summary(spark, sf):
    return research.share_summary(vecm_shares(spark, sf), ["symbol", "venue_a", "venue_b"])


_LAGS = ", ".join(f"x - lag(x, {k}) OVER w AS d_{k}" for k in (1, 2, 3))


@query(BASE + _GRID + f", x AS (SELECT symbol, venue, ts_ns, bid + ask AS x FROM gq WHERE age_ns <= {AGE}) SELECT symbol, venue, ts_ns, {_LAGS} FROM x WINDOW w AS (PARTITION BY symbol, venue ORDER BY ts_ns)")
def lag_matrix(spark, sf):
    x = gridded(spark, sf).where(F.col("age_ns") <= AGE).withColumn("x", F.col("bid") + F.col("ask"))
    return x.select("symbol", "venue", "ts_ns", *[(F.col("x") - F.lag("x", k).over(_leg())).alias(f"d_{k}") for k in (1, 2, 3)])


def _learnable(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose target follows one feature upward, another either way, with some values missing."""
    q = _dated(spark, sf)
    noise = F.pmod(F.col("arrival") * 7919, F.lit(101)).cast("double") / 101 - 0.5
    return q.select("date", "ts_ns", "arrival", F.when(F.col("k") % 11 != 0, F.col("k") / 50.0 - 1).alias("click_ofi"),
        (F.col("user_id") / 75.0 - 1).alias("view_imbalance"),
                    (F.col("k") / 50.0 - 1 + 0.3 * F.abs(F.col("user_id") / 75.0 - 1) + noise).alias("y"))


BOOST = {"rounds": 5, "rate": 0.5, "depth": 2, "least": 20, "bins": 16}


@query(None)
def boosted_folds(spark, sf):
    """Every model's out-of-sample score by fold: no view, ridge on flow, ridge on all, boosted trees."""
    rows = _learnable(spark, sf)
    dates = sorted(r[0] for r in rows.select("date").distinct().collect())
    oos = research.evaluate_folds(rows, dates, ["click_ofi", "view_imbalance"], 3, step=30, boosted=BOOST)
    return research.evaluate(oos, ["fold", "model"])


@query(None)
def venue_importance(spark, sf):
    rows = _learnable(spark, sf)
    beta, icept = research.ridge(rows, ["click_ofi", "view_imbalance"], "y")
    predict = research.linear(beta, icept, ["click_ofi", "view_imbalance"], {})
    return research.permutation_importance(rows, predict, ["click_ofi", "view_imbalance"], {"click_ofi": "click", "view_imbalance": "view"},
        repeats=2)


@query("WITH x AS (SELECT unnest(" + str(SYMBOLS) + ") AS s) SELECT s AS symbol, replace(s, '-', '_') AS prefix FROM x")
def leg_prefixes(spark, sf):
    return spark.createDataFrame([(s,) for s in SYMBOLS], "symbol string").select("symbol",
        features.leg_prefix(F.col("symbol")).alias("prefix"))


@query(BASE + _EV + """, c AS (SELECT date, CASE WHEN abs(y) > threshold THEN sign(y) ELSE 0 END AS y, CASE WHEN abs(p) > threshold THEN sign(p) ELSE 0 END AS p FROM z)
SELECT date, avg(CAST(CAST(y = 1 AS INTEGER) AS DOUBLE)) AS base_up, avg(CAST(CAST(y = -1 AS INTEGER) AS DOUBLE)) AS base_down, avg(CAST(CAST(p <> 0 AS INTEGER) AS DOUBLE)) AS traded_share FROM c GROUP BY date""")
def base_rates(spark, sf):
    """How often each direction is right by itself, and how often the model trades, pooled by date."""
    rows = research.as_classes(_predicted(spark, sf))
    share = lambda c: F.avg(c.cast("double"))
    return rows.groupBy("date").agg(share(F.col("y") == 1).alias("base_up"), share(F.col("y") == -1).alias("base_down"),
        share(F.col("p") != 0).alias("traded_share"))


@query(BASE + """SELECT arrival, CASE WHEN venue = 'view' THEN k END AS view_x, CASE WHEN venue = 'click' THEN size END AS click_x FROM q WHERE venue IN ('view', 'click')""")
def families_by_date(spark, sf):
    """Frames whose columns differ, one below the other: what a frame has not is null."""
    q = quotes(spark, sf)
    view = q.where("venue = 'view'").select("arrival", F.col("k").alias("view_x"))
    return view.unionByName(q.where("venue = 'click'").select("arrival", F.col("size").alias("click_x")), allowMissingColumns=True)
