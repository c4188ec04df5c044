"""Queries over the marts: the scorecard and its budget, exporter gauges, alerts, and the dashboard, with their SQL twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.operators import dashboard, metrics, quantiles, scorecard, silver
from quaymark.plans.market import AGE, BASE, H, SQL, SYMBOLS, VENUES, _nbbo_sql, basis_summary, nbbo_evict_stale, query, quotes
from quaymark.plans.silver import DATE, FACTS, MESSAGES, dated, facts, latency_rows
from quaymark.sources import lake

def _status(spark: SparkSession, sf: str) -> DataFrame:
    q = dated(quotes(spark, sf)).select(F.col("venue").alias("exchange"), "date", "ts_ns", F.col("arrival").alias("offset"), "state")
    return scorecard.transitions(q, ["exchange", "date"], "ts_ns", "offset")


def _expected(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(v, s) for s in SYMBOLS for v in [*VENUES, "idle"]], "exchange string, canonical_symbol string")


def card(spark: SparkSession, sf: str) -> DataFrame:
    """The scorecard of every date of the events."""
    return scorecard.scorecard(silver.book_quality(facts(spark, sf)), latency_rows(spark, sf), _status(spark, sf), _expected(spark))


_BY = "exchange, canonical_symbol, date"
CARD = BASE + FACTS + MESSAGES + f""", lat AS (SELECT {_BY}, dataset, CAST(local_ts_ns - exchange_ts_ns AS DOUBLE) / 1000000.0 AS ms FROM m WHERE exchange_ts_ns <> 0 AND recv_ns IS NOT NULL AND dataset <> 'bbo'),
st AS (SELECT venue AS exchange, {DATE} AS date, ts_ns, arrival, state, lag(state) OVER w AS prev, lag(ts_ns) OVER w AS pts FROM q WINDOW w AS (PARTITION BY venue, {DATE} ORDER BY ts_ns, arrival)),
cl AS (SELECT {_BY}, epoch, local_recv_ts_ns AS r, lag(local_recv_ts_ns) OVER w AS pr, lag(epoch) OVER w AS pe FROM f WHERE kind = 'delta' AND local_recv_ts_ns IS NOT NULL
  WINDOW w AS (PARTITION BY {_BY} ORDER BY epoch, sequence, "offset")),
cs AS (SELECT {_BY}, count_if(r < pr AND pe = epoch) AS intra, count_if(r < pr AND pe <> epoch) AS inter, coalesce(max(CASE WHEN r < pr AND pe = epoch THEN pr - r END), 0) AS worst FROM cl GROUP BY ALL),
kinds AS (SELECT {_BY}, invariant_kind, count(*) AS n, count_if(coalesce(invariant_kind IN ('snapshot_crossed', 'crossed_after_delta'), false) AND best_bid = best_ask) AS locked FROM f GROUP BY ALL),
tally AS (SELECT {_BY}, sum(n) AS n, sum(CASE WHEN invariant_kind IS NOT NULL THEN n ELSE 0 END) AS v, CAST(sum(CASE WHEN invariant_kind IS NOT NULL THEN locked ELSE 0 END) AS BIGINT) AS locked,
  max(CASE WHEN invariant_kind = 'crossed_after_delta' THEN n END) AS a, max(CASE WHEN invariant_kind = 'non_monotonic_seq' THEN n END) AS b, max(CASE WHEN invariant_kind = 'snapshot_crossed' THEN n END) AS c FROM kinds GROUP BY ALL),
rows_ AS (
  SELECT {_BY}, 'sequence_gap' AS "check", count_if(kind = 'delta') AS n_records, count_if(kind = 'delta' AND seq_gap > 0) AS n_violations, NULL::DOUBLE AS p50_ms, NULL::DOUBLE AS p95_ms, NULL::DOUBLE AS p99_ms,
    '{{"max_gap":' || coalesce(max(CASE WHEN kind = 'delta' AND seq_gap > 0 THEN seq_gap END), 0) || ',"total_missing":' || CAST(coalesce(sum(CASE WHEN kind = 'delta' AND seq_gap > 0 THEN seq_gap END), 0) AS BIGINT) || '}}' AS detail
  FROM f GROUP BY ALL
  UNION ALL SELECT {_BY}, 'book_invariant', CAST(n AS BIGINT), CAST(v AS BIGINT), NULL, NULL, NULL, '{{' || CASE WHEN a IS NOT NULL THEN '"crossed_after_delta":' || a || ',' ELSE '' END || '"locked":' || locked
    || CASE WHEN b IS NOT NULL THEN ',"non_monotonic_seq":' || b ELSE '' END || CASE WHEN c IS NOT NULL THEN ',"snapshot_crossed":' || c ELSE '' END || '}}' FROM tally
  UNION ALL SELECT {_BY}, 'coverage', count(*), 0, NULL, NULL, NULL, '{{"deltas":' || count_if(kind = 'delta') || ',"snapshots":' || count_if(kind = 'snap') || '}}' FROM f GROUP BY ALL
  UNION ALL SELECT {_BY}, 'clock_monotonic', n, coalesce(intra, 0), NULL, NULL, NULL, '{{"inter_epoch_steps":' || coalesce(inter, 0) || ',"worst_lateness_ms":' || coalesce(worst, 0) // 1000000 || '.0}}'
    FROM (SELECT {_BY}, count_if(kind = 'delta') AS n FROM f GROUP BY ALL) LEFT JOIN cs USING ({_BY})
  UNION ALL SELECT {_BY}, 'latency.' || dataset, count(*), 0, quantile_cont(ms, 0.5), quantile_cont(ms, 0.95), quantile_cont(ms, 0.99), 'max_ms' FROM lat GROUP BY {_BY}, dataset
  UNION ALL SELECT exchange, NULL, date, 'venue_uptime', count(*), count_if(coalesce(prev <> state, false) AND state = 'down'), NULL, NULL, NULL, '{{"final_state":"' || arg_max(state, {{'t': ts_ns, 'a': arrival}}) || '"}}' FROM st GROUP BY exchange, date),
absent AS (SELECT x.exchange, x.canonical_symbol, d.date FROM (SELECT DISTINCT date FROM rows_) d, (SELECT unnest({[*VENUES, 'idle']}) AS exchange, s.canonical_symbol FROM (SELECT unnest({SYMBOLS}) AS canonical_symbol) s) x
  WHERE NOT EXISTS (SELECT 1 FROM rows_ r WHERE r.exchange = x.exchange AND r.canonical_symbol = x.canonical_symbol AND r.date = d.date)),
card AS (SELECT * FROM rows_ UNION ALL SELECT exchange, canonical_symbol, date, 'coverage', 0, 0, NULL, NULL, NULL, '{{"absent":true}}' FROM absent)
"""


@query(CARD + 'SELECT exchange, canonical_symbol, date, "check", n_records, n_violations, round(p50_ms, 6) AS p50_ms, round(p95_ms, 6) AS p95_ms, round(p99_ms, 6) AS p99_ms, detail FROM card')
def scorecard_rows(spark, sf):
    """Every row of every date; details with fractions as whole milliseconds, as engines write fractions differently."""
    rows = card(spark, sf)
    json = lambda p: F.get_json_object("detail", f"$.{p}")
    step = F.concat(F.lit('{"inter_epoch_steps":'), json("inter_epoch_steps"), F.lit(',"worst_lateness_ms":'),
        F.floor(json("worst_lateness_ms").cast("double")).cast("string"), F.lit(".0}"))
    state = F.concat(F.lit('{"final_state":"'), json("final_state"), F.lit('"}'))
    detail = F.when(F.col("check") == "clock_monotonic", step).when(F.col("check") == "venue_uptime",
        state).when(F.col("check").startswith("latency."), "max_ms").otherwise(F.col("detail"))
    return rows.select("exchange", "canonical_symbol", "date", "check", "n_records", "n_violations",
        *[F.round(f"{q}_ms", 6).alias(f"{q}_ms") for q in ("p50", "p95", "p99")], detail.alias("detail"))


BUDGET = """
default:
  max_violations: 1
checks:
  sequence_gap:
    max_violations: 0
    exchanges:
      view:
        max_violations: 1
        max_rate: 0.2
  coverage:
    max_violations: 0
    min_records: 3
    exchanges:
      view:
        symbols:
          AAA-USD:
            min_records: 30
  venue_uptime:
    max_violations: 2
  latency:
    max_p99_ms: 95
  latency.trades:
    max_p99_ms: 50
    exchanges:
      click:
        max_p99_ms: 90
"""
_LIMITS = """, lim AS (SELECT *, CASE "check" WHEN 'sequence_gap' THEN CASE WHEN exchange = 'view' THEN 1 ELSE 0 END WHEN 'coverage' THEN 0 WHEN 'venue_uptime' THEN 2 ELSE CASE WHEN "check" LIKE 'latency.%' THEN NULL ELSE 1 END END AS mv,
  CASE WHEN "check" = 'sequence_gap' AND exchange = 'view' THEN 0.2::DOUBLE END AS mr, CASE WHEN "check" = 'coverage' THEN CASE WHEN exchange = 'view' AND canonical_symbol = 'AAA-USD' THEN 30 ELSE 3 END END AS mn,
  CASE WHEN "check" = 'latency.trades' THEN CASE WHEN exchange = 'click' THEN 90 ELSE 50 END WHEN "check" LIKE 'latency.%' THEN 95 END AS mp FROM card)
SELECT exchange, canonical_symbol AS symbol, date, "check", 'max_violations' AS "limit", CAST(n_violations AS DOUBLE) AS value, CAST(mv AS DOUBLE) AS bound FROM lim WHERE n_violations > mv
UNION ALL SELECT exchange, canonical_symbol, date, "check", 'max_rate', CAST(n_violations AS DOUBLE) / n_records, mr FROM lim WHERE n_records > 0 AND CAST(n_violations AS DOUBLE) / n_records > mr
UNION ALL SELECT exchange, canonical_symbol, date, "check", 'min_records', CAST(n_records AS DOUBLE), CAST(mn AS DOUBLE) FROM lim WHERE n_records < mn
UNION ALL SELECT exchange, canonical_symbol, date, "check", 'max_p99_ms', round(p99_ms, 6), CAST(mp AS DOUBLE) FROM lim WHERE p99_ms > mp"""


@query(CARD + _LIMITS)
def scorecard_breaches(spark, sf):
    rules = spark.createDataFrame(scorecard.load_budget(BUDGET), scorecard.RULES)
    out = scorecard.breaches(card(spark, sf).withColumnRenamed("canonical_symbol", "symbol"), rules)
    return out.withColumn("value", F.when(F.col("limit") == "max_p99_ms", F.round("value", 6)).otherwise(F.col("value")))


@query(CARD + _LIMITS.replace("SELECT exchange, canonical_symbol AS symbol", ", br AS (SELECT exchange, canonical_symbol AS symbol", 1)
    + ") SELECT date, CAST(1 AS INTEGER) AS exit_code, count(*) AS n_breaches FROM br GROUP BY date")
def build_exits(spark, sf):
    """The dates whose build a gate would fail, with what fails it."""
    return scorecard_breaches(spark, sf).groupBy("date").agg(F.lit(1).alias("exit_code"), F.count("*").alias("n_breaches"))


@query(CARD + f"""SELECT date, count(*) AS n_rows, CAST(sum(n_violations) AS BIGINT) AS n_violations FROM card GROUP BY date""")
def scorecard_totals(spark, sf):
    return card(spark, sf).groupBy("date").agg(F.count("*").alias("n_rows"), F.sum("n_violations").alias("n_violations"))


def _flat(gauges: DataFrame) -> DataFrame:
    """Gauges with their labels as one sorted text."""
    pairs = F.transform(F.array_sort(F.map_entries("labels")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return gauges.select("metric", F.array_join(pairs, ",").alias("labels"), F.round("value", 6).alias("value"))


@query(CARD + """, l AS (SELECT * FROM card WHERE date = (SELECT max(date) FROM card)), t AS (SELECT *, coalesce(canonical_symbol, '') AS s FROM l)
SELECT 'gold_dq_violations' AS metric, 'check=' || "check" || ',exchange=' || exchange || ',symbol=' || s AS labels, CAST(n_violations AS DOUBLE) AS value FROM t
UNION ALL SELECT 'gold_dq_records', 'check=' || "check" || ',exchange=' || exchange || ',symbol=' || s, CAST(n_records AS DOUBLE) FROM t
UNION ALL SELECT 'gold_dq_latency_ms', 'dataset=' || substr("check", 9) || ',exchange=' || exchange || ',quantile=' || x.q || ',symbol=' || s, round(x.v, 6)
  FROM (SELECT *, unnest([{'q': 'p50', 'v': p50_ms}, {'q': 'p95', 'v': p95_ms}, {'q': 'p99', 'v': p99_ms}]) AS x FROM t WHERE "check" LIKE 'latency.%')
UNION ALL SELECT 'gold_dq_clock_worst_ms', 'exchange=' || exchange || ',symbol=' || canonical_symbol, CAST(coalesce(worst, 0) AS DOUBLE) / 1000000.0 FROM (SELECT DISTINCT exchange, canonical_symbol, date FROM f) k LEFT JOIN cs USING (exchange, canonical_symbol, date)
  WHERE date = (SELECT max(date) FROM card)
UNION ALL SELECT 'gold_scorecard_date_seconds', '', CAST(epoch(CAST(max(date) AS TIMESTAMP)) AS DOUBLE) FROM card""")
def exporter_scorecard(spark, sf):
    return _flat(metrics.scorecard_families(metrics.latest(card(spark, sf).persist()).persist()))  # read five times


@query(SQL["basis_summary"].replace("SELECT base, strftime", ", days AS (SELECT base, strftime", 1) + """), l AS (SELECT * FROM days WHERE date = (SELECT max(date) FROM days))
SELECT 'gold_basis_bps' AS metric, 'base=' || base || ',stat=' || x.s AS labels, x.v AS value FROM (SELECT base, unnest([{'s': 'mean', 'v': basis_bps_mean}, {'s': 'std', 'v': basis_bps_std}, {'s': 'min', 'v': basis_bps_min}, {'s': 'max', 'v': basis_bps_max}]) AS x FROM l)
UNION ALL SELECT 'gold_basis_obs', 'base=' || base, CAST(n_obs AS DOUBLE) FROM l""")
def exporter_basis(spark, sf):
    return _flat(metrics.basis_families(metrics.latest(basis_summary(spark, sf))))


MARKS = f""", w AS (SELECT venue AS dataset, CASE WHEN venue < 'f' THEN 'silver' ELSE 'gold' END AS layer, max(CASE WHEN k % 2 = 0 THEN ts_ns END) / 1000000000.0::DOUBLE AS marked, max(ts_ns) / 1000000000.0::DOUBLE AS newest FROM q GROUP BY ALL)"""


def _marks(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    q = quotes(spark, sf).select(F.col("venue").alias("dataset"), F.when(F.col("venue") < "f", "silver").otherwise("gold").alias("layer"),
        "k", "ts_ns")
    marked = q.where("k % 2 = 0").groupBy("layer", "dataset").agg((F.max("ts_ns") / 1e9).alias("written_at_epoch"))
    return marked, q.groupBy("layer", "dataset").agg((F.max("ts_ns") / 1e9).alias("at"))


@query(BASE + MARKS + """SELECT 'lake_freshness_seconds' AS metric, 'dataset=' || dataset || ',layer=' || layer AS labels, round(greatest(0.0, 1706600000.0::DOUBLE - newest), 3) AS value FROM w
UNION ALL SELECT 'lake_freshness_marker_skew_seconds', 'dataset=' || dataset || ',layer=' || layer, round(abs(marked - newest), 3) FROM w""")
def exporter_freshness(spark, sf):
    marked, newest = _marks(spark, sf)
    both = metrics.freshness_families(newest, 1_706_600_000.0).unionByName(metrics.marker_skew(marked, newest))
    return _flat(both).withColumn("value", F.round("value", 3))


#: The alerts with spans that suit events minutes apart, in microseconds.
SPAN = 200 * 1_000_000
RULES = [(name, metric, how, span * SPAN, by, test, bound / SPAN * 5 if how == "rate" else bound, hold * SPAN) for name, metric, how, span,
    by, test, bound, hold in metrics.ALERTS]


def samples(spark: SparkSession, sf: str) -> DataFrame:
    """Events as samples of every alert's metric: counters that rise and reset, gauges that cross their bounds."""
    q = quotes(spark, sf)
    labels = F.create_map(F.lit("exchange"), F.col("venue"), F.lit("canonical_id"), F.col("symbol"), F.lit("kind"),
        (F.col("k") % 2).cast("string"), F.lit("layer"), F.lit("bronze"), F.lit("check"), F.lit("clock_monotonic"))
    ts = F.expr("ts_ns div 1000")
    value = {"rate": (F.col("arrival") * 3) % 4001, "value": F.col("k") * 1200, "max": F.col("k") * 20, "min": F.col("k") * 40,
        "changes": F.floor(F.col("arrival") / 700), "age": ts - F.col("k") * 10}
    # a branch a metric, as what reads one metric then leaves the others out before it makes their rows
    one = {m.partition("{")[0]: F.when(F.lit(t == "==") & (F.col("k") < 60), 0).otherwise(value[how]).cast("double") for _, m, how, _, _, t, _, _ in RULES}
    return reduce(DataFrame.unionByName, [q.select(F.lit(m).alias("metric"), labels.alias("labels"), ts.alias("ts"), v.alias("value"))
        for m, v in one.items()])


def _alerts_sql() -> str:
    """The board in SQL, rule by rule."""
    value = {"rate": "(arrival * 3) % 4001", "value": "k * 1200", "max": "k * 20", "min": "k * 40", "changes": "arrival // 700",
        "age": "ts_ns // 1000 - k * 10"}
    label = {"exchange": "venue", "canonical_id": "symbol", "kind": "CAST(k % 2 AS VARCHAR)"}
    full = "'{\"canonical_id\":\"' || symbol || '\",\"check\":\"clock_monotonic\",\"exchange\":\"' || venue || '\",\"kind\":\"' || (k % 2) || '\",\"layer\":\"bronze\"}'"
    parts = []
    for i, (name, _, how, span, by, test, bound, hold) in enumerate(RULES):
        v = value[how] if test == ">" else f"CASE WHEN k < 60 THEN 0 ELSE {value[how]} END"
        series = full if by is None else "'{}'" if not by else "'{' || " + " || ',' || ".join(f"'\"{b}\":\"' || {label[b]} || '\"'"
            for b in sorted(by)) + " || '}'"
        head = f"s{i} AS (SELECT {full} AS f, {series} AS series, ts_ns // 1000 AS ts, CAST({v} AS DOUBLE) AS v FROM q)"
        if how == "rate":
            got = (f"(SELECT series, ts, sum(r) AS value FROM (SELECT series, ts, sum(d) OVER (PARTITION BY f, series ORDER BY ts RANGE BETWEEN {span - 1} PRECEDING AND CURRENT ROW) / {float(span)}::DOUBLE AS r FROM "
                   f"(SELECT *, CASE WHEN lag(v) OVER w IS NULL THEN 0 WHEN v >= lag(v) OVER w THEN v - lag(v) OVER w ELSE v END AS d FROM s{i} WINDOW w AS (PARTITION BY f, series ORDER BY ts))) GROUP BY ALL)")
        elif how == "changes":
            got = (f"(SELECT series, ts, CAST(sum(d) OVER (PARTITION BY series ORDER BY ts RANGE BETWEEN {span - 1} PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM "
                   f"(SELECT *, CASE WHEN v <> lag(v) OVER (PARTITION BY series ORDER BY ts) THEN 1 ELSE 0 END AS d FROM s{i}))")
        elif how == "age":
            got = f"(SELECT series, ts, ts - v AS value FROM s{i})"
        else:
            got = f"(SELECT series, ts, {'min' if how == 'min' else 'max'}(v) AS value FROM s{i} GROUP BY ALL)"
        body = (f"a{i} AS (SELECT *, value {'>' if test == '>' else '='} {float(bound)!r}::DOUBLE AS active FROM {got}), "
                f"e{i} AS (SELECT *, sum(CASE WHEN active IS DISTINCT FROM p THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, lag(active) OVER (PARTITION BY series ORDER BY ts) AS p FROM a{i}))")
        parts.append((f"{head}, {body}",
            f"SELECT '{name}' AS alert, series, ts, round(value, 14) AS value, active, active AND ts - min(ts) OVER (PARTITION BY series, run) >= {hold} AS firing FROM e{i}"))
    return BASE + ", " + ", ".join(p[0] for p in parts) + " " + " UNION ALL ".join(p[1] for p in parts)


@query(_alerts_sql())
def alert_board(spark, sf):
    return metrics.alerts(samples(spark, sf), RULES).withColumn("value", F.round("value", 14))


@query(BASE + """, s AS (SELECT symbol, ts_ns // 1000000000 AS ts, max(arrival % 3000) AS a, max(arrival % 4000) AS b FROM q GROUP BY ALL),
r AS (SELECT symbol, ts, sum(da) OVER w AS ra, sum(db) OVER w AS rb FROM (SELECT *, CASE WHEN lag(a) OVER v IS NULL THEN 0 WHEN a >= lag(a) OVER v THEN a - lag(a) OVER v ELSE a END AS da,
  CASE WHEN lag(b) OVER v IS NULL THEN 0 WHEN b >= lag(b) OVER v THEN b - lag(b) OVER v ELSE b END AS db FROM s WINDOW v AS (PARTITION BY symbol ORDER BY ts)) WINDOW w AS (PARTITION BY symbol ORDER BY ts RANGE BETWEEN 21599 PRECEDING AND CURRENT ROW))
SELECT symbol, ts, round(CASE WHEN rb <> 0 THEN (ra / 21600.0::DOUBLE) / (rb / 21600.0::DOUBLE) * 100.0 END, 6) AS ratio FROM r""")
def bbo_per_delta(spark, sf):
    s = quotes(spark, sf).groupBy("symbol", F.expr("ts_ns div 1000000000").alias("ts")).agg(F.max(F.col("arrival") % 3000).alias("a"),
        F.max(F.col("arrival") % 4000).alias("b"))
    out = metrics.share(metrics.rate(s, ["symbol"], "ts", "a", 21600), metrics.rate(s, ["symbol"], "ts", "b", 21600), ["symbol"], "ts")
    return out.withColumn("ratio", F.round("ratio", 6))


@query(CARD + """, l AS (SELECT * FROM card WHERE date = (SELECT max(date) FROM card)) SELECT "check", exchange, canonical_symbol, n_violations, CAST(sum(n_violations) OVER (PARTITION BY "check") AS BIGINT) AS check_total FROM l WHERE n_violations > 0""")
def offenders(spark, sf):
    from pyspark.sql import Window

    rows = metrics.latest(card(spark, sf)).where("n_violations > 0")
    return rows.select("check", "exchange", "canonical_symbol", "n_violations",
        F.sum("n_violations").over(Window.partitionBy("check")).alias("check_total"))


@query(BASE + """, w AS (SELECT *, lag(bid) OVER v AS pb, lag(ask) OVER v AS pa, lead(arrival) OVER v AS n FROM (SELECT symbol, venue, arrival, ts_ns, bid, CASE WHEN k < 4 THEN bid - 5 ELSE ask END AS ask FROM q) WINDOW v AS (PARTITION BY symbol, venue ORDER BY arrival))
SELECT symbol, venue, ts_ns, bid, ask, ask - bid AS spread, CAST(ask + bid AS DOUBLE) / 2 AS mid, ask < bid AS crossed, CASE WHEN bid > pb THEN 'up' WHEN ask < pa THEN 'down' END AS tick FROM w WHERE n IS NULL""")
def bbo_table(spark, sf):
    q = quotes(spark, sf).withColumn("ask", F.when(F.col("k") < 4, F.col("bid") - 5).otherwise(F.col("ask")))
    return dashboard.tops(q, ["symbol", "venue"], "arrival")


@query(_nbbo_sql(AGE, False, """, l AS (SELECT *, lead(ts_ns) OVER (PARTITION BY symbol ORDER BY ts_ns) AS n FROM nbbo), c AS (SELECT max(ts_ns) AS now FROM q),
lt AS (SELECT l.*, (SELECT max(q.ts_ns) FROM q WHERE q.symbol = l.symbol AND q.venue = l.bid_venue AND q.ts_ns <= l.ts_ns) AS bid_at, (SELECT max(q.ts_ns) FROM q WHERE q.symbol = l.symbol AND q.venue = l.ask_venue AND q.ts_ns <= l.ts_ns) AS ask_at FROM l WHERE n IS NULL)
SELECT symbol, best_bid, bid_venue, best_ask, ask_venue, best_ask - best_bid AS spread, CAST(best_ask + best_bid AS DOUBLE) / 2 AS mid, best_ask < best_bid AS crossed, n_venues, now - bid_at > 3600000000000 AS bid_stale, now - ask_at > 3600000000000 AS ask_stale FROM lt, c"""))
def nbbo_table(spark, sf):
    q, best = quotes(spark, sf), nbbo_evict_stale(spark, sf)
    seen = q.groupBy("symbol", "venue").agg(F.max("ts_ns").alias("at"))
    legs = best.join(seen.select("symbol", F.col("venue").alias("bid_venue"), F.col("at").alias("bid_at")), ["symbol", "bid_venue"]).join(
        seen.select("symbol", F.col("venue").alias("ask_venue"), F.col("at").alias("ask_at")), ["symbol", "ask_venue"])
    return dashboard.consolidated(legs, "ts_ns", dashboard.now(q, "ts_ns"), H)


@query(BASE + f""", l AS (SELECT symbol, venue, arg_max(ts_ns, arrival) AS ts_ns, CAST(arg_max(bid, arrival) + arg_max(ask, arrival) AS DOUBLE) / 2 AS mid FROM q WHERE NOT (venue = 'view' AND symbol = 'AAA-USD') GROUP BY ALL),
a AS (SELECT *, CAST(greatest(0, (SELECT max(ts_ns) FROM q) - ts_ns) AS DOUBLE) / 1000000.0 AS age FROM l) SELECT symbol, """ + ", ".join(f"max(mid) FILTER (venue = '{v}') AS {v}_mid, max(age) FILTER (venue = '{v}') AS {v}_age_ms" for v in VENUES) + " FROM a GROUP BY symbol")
def venue_matrix(spark, sf):
    q = quotes(spark, sf)
    tops = q.where("not (venue = 'view' and symbol = 'AAA-USD')").groupBy("symbol",
        "venue").agg(F.max_by("ts_ns", "arrival").alias("ts_ns"),
        ((F.max_by("bid", "arrival") + F.max_by("ask", "arrival")) / 2).alias("mid"))
    return dashboard.matrix(tops, VENUES, dashboard.now(q, "ts_ns"))


@query(BASE + f"""SELECT venue, count(*) AS n_messages, max(ts_ns) AS last_ns, CAST(greatest(0, (SELECT max(ts_ns) FROM q) - max(ts_ns)) AS DOUBLE) / 1000000.0 AS age_ms, (SELECT max(ts_ns) FROM q) - max(ts_ns) > {H // 4} AS stale FROM q GROUP BY venue""")
def venue_staleness(spark, sf):
    return dashboard.venues(quotes(spark, sf), "ts_ns", H // 4)


@query(BASE + f"SELECT venue, arrival, count(*) OVER (PARTITION BY venue ORDER BY ts_ns RANGE BETWEEN {6 * H - 1} PRECEDING AND CURRENT ROW) AS n_in_span FROM q")
def message_rate(spark, sf):
    return dashboard.rates(quotes(spark, sf), ["venue"], "ts_ns", 6 * H).select("venue", "arrival", "n_in_span")


@query(BASE + f", l AS (SELECT venue, ts_ns, lead(ts_ns) OVER (PARTITION BY venue ORDER BY ts_ns) - ts_ns AS stalled_ns FROM q) SELECT * FROM l WHERE stalled_ns > {H}")
def feed_stalls(spark, sf):
    return dashboard.stalls(quotes(spark, sf), ["venue"], "ts_ns", H)


@query("SELECT l_linestatus AS mode, l_returnflag AS flag, round(quantile_cont(l_extendedprice, 0.01), 6) AS p1, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.999), 6) AS p999 FROM lineitem GROUP BY ALL")
def exact_percentiles(spark, sf):
    """Percentiles of groups by the two-pass way, whatever their size."""
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_linestatus").alias("mode"), F.col("l_returnflag").alias("flag"),
        F.col("l_extendedprice").alias("x"))
    out = quantiles.percentiles(rows, ["mode", "flag"], "x", [0.01, 0.5, 0.999], small=0)
    return out.select("mode", "flag", *[F.round(F.col("p")[i], 6).alias(n) for i, n in enumerate(("p1", "p50", "p999"))])


@query(None)
def lake_contract(spark, sf):
    """The declared columns of every dataset, a row each."""
    rows = [(at, name, f.name, f.dataType.simpleString()) for at, name in lake.SCHEMAS for f in lake.schema(at, name)]
    return spark.createDataFrame(rows, "layer string, dataset string, column string, type string")
