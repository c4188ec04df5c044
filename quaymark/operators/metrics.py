"""The metrics plane: counter rates, alerts that hold for a time, histogram quantiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _trailing(rows: DataFrame, by: list[str], ts: str, value: str, out: str, span: int) -> DataFrame:
    """``out``: the sum of ``value`` over the rows at ``ts - span + 1`` to ``ts``; ``ts`` and ``span`` are whole numbers.

    A sliding frame adds all its rows anew for each row, which grows with the square of their density. Here time is cut
    into stretches of ``span``: a frame is the head of its own stretch and the tail of the one before, both running sums.
    Nothing is subtracted, so that large steps leave no remainder and infinite ones no NaN."""
    at = F.col(ts)
    cut = rows.withColumn("_at", at - F.pmod(at, F.lit(span)))
    part = Window.partitionBy(*by, "_at")
    head = cut.withColumn("_head", F.sum(value).over(part.orderBy(ts)))
    kind = head.schema["_head"].dataType
    # each row as itself, and as a part of the tails that the next stretch's rows need: of those as late as itself, less a span
    own = F.struct(F.col("_at").alias("at"), at.alias("pos"), F.lit(True).alias("own"), F.lit(None).cast(rows.schema[value].dataType).alias("v"))
    past = F.struct((F.col("_at") + span).alias("at"), (at + (span - 1)).alias("pos"), F.lit(False).alias("own"), F.col(value).alias("v"))
    both = head.withColumn("_r", F.explode(F.when(at.isNull(), F.array(own)).otherwise(F.array(own, past))))
    both = both.drop("_at").select("*", F.col("_r.at").alias("_at"), F.col("_r.pos").alias("_pos"), F.col("_r.own").alias("_own"), F.col("_r.v").alias("_v"))
    back = part.orderBy(F.desc("_pos"), "_own").rowsBetween(Window.unboundedPreceding, 0)
    met = both.withColumn("_tail", F.sum("_v").over(back)).where("_own")
    total = F.when(F.col("_tail").isNull(), F.col("_head")).when(F.col("_head").isNull(), F.col("_tail")).otherwise(F.col("_head") + F.col("_tail"))
    return met.withColumn(out, total.cast(kind)).drop("_r", "_at", "_pos", "_own", "_v", "_head", "_tail")


def increase(samples: DataFrame, by: list[str], ts: str, value: str, span: int) -> DataFrame:
    """``increase``: how much a counter grew in the ``span`` before each sample, across resets.

    The sum of the steps between samples, without extrapolation to the window's edges; after
    a reset the new value is the step."""
    w = Window.partitionBy(*by).orderBy(ts)
    prev = F.lag(value).over(w)
    step = F.when(prev.isNull(), 0).when(F.col(value) >= prev, F.col(value) - prev).otherwise(F.col(value))
    return _trailing(samples.withColumn("_step", step), by, ts, "_step", "increase", span).drop("_step")


def changes(samples: DataFrame, by: list[str], ts: str, value: str, span: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(ts)
    moved = F.coalesce((F.col(value) != F.lag(value).over(w)).cast("int"), F.lit(0))
    return _trailing(samples.withColumn("_m", moved), by, ts, "_m", "changes", span).drop("_m")


def firing(samples: DataFrame, by: list[str], ts: str, condition: Column, hold: int | Column) -> DataFrame:
    """``active`` and ``firing``: the condition, and whether it has held for at least ``hold``."""
    w = Window.partitionBy(*by).orderBy(ts)
    on = samples.withColumn("active", F.coalesce(condition, F.lit(False)))
    edge = F.coalesce(F.col("active") != F.lag("active").over(w), F.lit(True))
    runs = on.withColumn("_e", edge)
    # time only rises, so that the last edge so far is the start of the run
    since = F.max(F.when(F.col("_e"), F.col(ts))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    return runs.withColumn("firing", F.col("active") & (F.col(ts) - since >= hold)).drop("_e")


def histogram_quantile(buckets: DataFrame, by: list[str], q: float) -> DataFrame:
    """``buckets(le, n)`` with cumulative counts, ``le`` null for infinity: linear within the bucket.

    In the open bucket the quantile is the last finite bound."""
    le = F.coalesce(F.col("le").cast("double"), F.lit(float("inf")))
    w = Window.partitionBy(*by).orderBy("_le")
    rows = buckets.withColumn("_le", le)
    rows = rows.withColumn("_total", F.max("n").over(Window.partitionBy(*by))).withColumn("_n0",
        F.coalesce(F.lag("n").over(w), F.lit(0))).withColumn("_le0", F.coalesce(F.lag("_le").over(w), F.lit(0.0)))
    hit = rows.where((F.col("n") >= F.col("_total") * q) & (F.col("_total") > 0))
    first = hit.groupBy(*by).agg(F.min(F.struct("_le", "n", "_n0", "_le0", "_total")).alias("h")).select(*by, "h.*")
    inside = F.col("_le0") + (F.col("_le") - F.col("_le0")) * F.try_divide(F.col("_total") * q - F.col("_n0"), F.col("n") - F.col("_n0"))
    return first.select(*by, F.when(F.col("_le") == float("inf"), F.col("_le0")).otherwise(inside).alias("quantile"))


def rate(samples: DataFrame, by: list[str], ts: str, value: str, span: int) -> DataFrame:
    """``rate``: the increase over the ``span`` before each sample, by its length; no extrapolation to its edges."""
    return increase(samples, by, ts, value, span).withColumn("rate", F.col("increase") / F.lit(float(span)))


def summed_rate(samples: DataFrame, series: list[str], by: list[str], ts: str, value: str, span: int) -> DataFrame:
    """``rate`` by ``by`` and time, over all series: each series' own first, as a counter resets by itself."""
    return rate(samples, series, ts, value, span).groupBy(*by, ts).agg(F.sum("rate").alias("rate"))


def share(part: DataFrame, whole: DataFrame, by: list[str], ts: str, factor: float = 100.0) -> DataFrame:
    """``ratio``: one summed rate over another at the same times; null where the other is 0."""
    both = part.select(*by, ts, F.col("rate").alias("_a")).join(whole.select(*by, ts, F.col("rate").alias("_b")), [*by, ts])
    return both.select(*by, ts, F.when(F.col("_b") != 0, F.col("_a") / F.col("_b") * factor).alias("ratio"))


MINUTE = 60
#: Alert, metric, how it is read (and over which span), the labels it is summed by, test, and for how long it must hold.
ALERTS = [
    ("GatewayBBOCrossed", "gateway_bbo_crossed_total", "rate", 5 * MINUTE, ("exchange",), ">", 0.0, 2 * MINUTE),
    ("GatewayNBBOCrossed", "gateway_nbbo_crossed_material_total", "rate", 5 * MINUTE, ("canonical_id",), ">", 0.0, 2 * MINUTE),
    ("BookInvariantViolations", "md_book_invariant_violations_total", "rate", 5 * MINUTE, ("exchange", "kind"), ">", 0.0, 2 * MINUTE),
    ("BookResyncStorm", "md_book_resyncs_total", "rate", 5 * MINUTE, ("exchange",), ">", 0.02, 10 * MINUTE),
    ("VenueDown", "gateway_venue_up", "value", 0, None, "==", 0.0, MINUTE),
    ("GatewayConsumerLagHigh", "gateway_consumer_lag_messages", "value", 0, None, ">", 50000.0, 5 * MINUTE),
    ("MaterializerLagHigh", "bronze_consumer_lag_messages", "value", 0, None, ">", 50000.0, 10 * MINUTE),
    ("TargetDown", "up", "value", 0, None, "==", 0.0, MINUTE),
    ("RecvClockBackwardStep", "md_recv_clock_worst_step_ms", "max", 0, ("exchange",), ">", 1000.0, 5 * MINUTE),
    ("GatewayRestarted", "gateway_process_start_time_seconds", "changes", 15 * MINUTE, None, ">", 0.0, 0),
    ("BronzeLakeStale", "lake_freshness_seconds{layer=bronze}", "min", 0, (), ">", 1800.0, 5 * MINUTE),
    ("CaptureClockStepLarge", "gold_dq_clock_worst_ms", "value", 0, None, ">", 1000.0, 0),
    ("ClockStepsElevated", "gold_dq_violations{check=clock_monotonic}", "value", 0, None, ">", 100.0, 10 * MINUTE),
    ("LakeExporterStale", "lake_exporter_last_success_seconds", "age", 0, None, ">", 600.0, 5 * MINUTE),
]


def selected(samples: DataFrame, metric: str) -> DataFrame:
    """The samples ``(metric, labels map, ts, value)`` of a name with label matches in braces."""
    name, _, match = metric.partition("{")
    out = samples.where(F.col("metric") == name)
    for pair in match.rstrip("}").split(",") if match else []:
        key, _, want = pair.partition("=")
        out = out.where(F.col("labels")[key] == want)
    return out


def alerts(samples: DataFrame, rules: list[tuple] = ALERTS) -> DataFrame:
    """Every alert at every evaluation that has a sample: ``(alert, series, ts, value, active, firing)``.

    ``samples(metric string, labels map<string,string>, ts long, value double)``. ``series`` holds the labels that
    an alert is by, as sorted JSON. An alert fires once its test has held for as long as its rule says.
    Rules that are read in the same way over the same span go through the samples together."""
    from functools import reduce

    alike: dict[tuple, list[int]] = {}
    for i, (_, _, how, span, *_) in enumerate(rules):
        alike.setdefault((how, span if how in ("rate", "changes") else 0), []).append(i)
    full = F.to_json(F.map_from_entries(F.sort_array(F.map_entries("labels"))))

    def kept(by: tuple | None) -> Column:
        if by is None:
            return full
        return F.to_json(F.map_from_arrays(F.array(*[F.lit(b) for b in sorted(by)]),
            F.array(*[F.coalesce(F.col("labels")[b], F.lit("")) for b in sorted(by)]))) if by else F.lit("{}")

    def of_rule(own: list[int], one: Callable[[int], Column]) -> Column:
        return reduce(lambda out, i: out.when(F.col("_rule") == i, one(i)), own[1:], F.when(F.col("_rule") == own[0], one(own[0])))

    parts, key = [], ["_rule", "series"]
    for (how, span), own in alike.items():
        rows = reduce(DataFrame.unionByName, [selected(samples, rules[i][1]).select(F.lit(i).alias("_rule"), kept(rules[i][4]).alias("series"),
            *[full.alias("_full")] * (how == "rate"), "ts", "value") for i in own])
        if how == "rate":
            got = summed_rate(rows, ["_full", *key], key, "ts", "value", span).select(*key, "ts", F.col("rate").alias("value"))
        elif how == "changes":
            got = changes(rows, key, "ts", "value", span).select(*key, "ts", F.col("changes").cast("double").alias("value"))
        elif how == "age":
            got = rows.select(*key, "ts", (F.col("ts") - F.col("value")).alias("value"))
        elif how == "value":
            # a series seldom has two samples of one time: these meet in the order that firing needs anyway
            at = Window.partitionBy(*key).orderBy("ts")
            got = rows.select(*key, "ts", F.max("value").over(at.rangeBetween(0, 0)).alias("value"), F.lead("ts").over(at).alias("_next"),
                F.lead(F.lit(1)).over(at).alias("_more")).where("_more is null or not (ts <=> _next)").drop("_next", "_more")
        else:
            got = rows.groupBy(*key, "ts").agg({"max": F.max, "min": F.min}[how]("value").alias("value"))
        on = of_rule(own, lambda i: F.col("value") > rules[i][6] if rules[i][5] == ">" else F.col("value") == rules[i][6])
        held = firing(got, key, "ts", on, of_rule(own, lambda i: F.lit(rules[i][7]).cast("long")))
        parts.append(held.select(of_rule(own, lambda i: F.lit(rules[i][0])).alias("alert"), "series", "ts", "value", "active", "firing"))
    return reduce(DataFrame.unionByName, parts)


def _gauge(df: DataFrame, name: str, labels: dict[str, Column], value: Column) -> DataFrame:
    entries = F.map_from_arrays(F.array(*[F.lit(k) for k in labels]),
        F.array(*[v.cast("string") for v in labels.values()])) if labels else F.map_from_arrays(F.array().cast("array<string>"),
        F.array().cast("array<string>"))
    return df.select(F.lit(name).alias("metric"), entries.alias("labels"), value.cast("double").alias("value"))


def freshness_families(newest: DataFrame, now: float) -> DataFrame:
    """``newest(layer, dataset, at)`` to seconds since, never below 0."""
    return _gauge(newest, "lake_freshness_seconds", {"layer": F.col("layer"), "dataset": F.col("dataset")},
        F.greatest(F.lit(0.0), F.lit(now) - F.col("at")))


def scorecard_families(rows: DataFrame) -> DataFrame:
    """The gauges of one date's scorecard: violations, records, latency quantiles, worst clock step, and the date itself."""
    from functools import reduce

    sym = F.coalesce("canonical_symbol", F.lit(""))
    labels = {"check": F.col("check"), "exchange": F.col("exchange"), "symbol": sym}
    lat = rows.where(F.col("check").startswith("latency.")).select(
        "exchange", sym.alias("symbol"), F.substring("check", len("latency.") + 1, 1000).alias("dataset"),
        F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"{q}_ms").alias("v"))
        for q in ("p50", "p95", "p99")])).alias("x")).where("x.v is not null")
    step = rows.where("check = 'clock_monotonic'").withColumn("_w",
        F.get_json_object("detail", "$.worst_lateness_ms").cast("double")).where("_w is not null")
    parts = [
        _gauge(rows, "gold_dq_violations", labels, F.col("n_violations")),
        _gauge(rows, "gold_dq_records", labels, F.col("n_records")),
        _gauge(lat, "gold_dq_latency_ms", {"exchange": F.col("exchange"), "symbol": F.col("symbol"), "dataset": F.col("dataset"),
        "quantile": F.col("x.q")}, F.col("x.v")),
        _gauge(step, "gold_dq_clock_worst_ms", {"exchange": F.col("exchange"), "symbol": sym}, F.col("_w")),
        _gauge(rows.select("date").distinct(), "gold_scorecard_date_seconds", {}, F.unix_timestamp(F.to_timestamp("date", "yyyy-MM-dd"))),
    ]
    return reduce(DataFrame.unionByName, parts)


def basis_families(rows: DataFrame) -> DataFrame:
    """The gauges of one date's basis summary: four statistics, and how many observations are behind them."""
    tall = rows.select("base", F.explode(F.array(*[F.struct(F.lit(q).alias("q"), F.col(f"basis_bps_{q}").alias("v"))
        for q in ("mean", "std", "min", "max")])).alias("x")).where("x.v is not null")
    return _gauge(tall, "gold_basis_bps", {"base": F.col("base"), "stat": F.col("x.q")},
        F.col("x.v")).unionByName(_gauge(rows, "gold_basis_obs", {"base": F.col("base")}, F.col("n_obs")))


def marker_skew(markers: DataFrame, newest: DataFrame) -> DataFrame:
    """How far each dataset's marker is from its newest object: ``markers(layer, dataset, written_at_epoch)``, ``newest(layer, dataset, at)``."""
    met = markers.join(newest, ["layer", "dataset"])
    return _gauge(met, "lake_freshness_marker_skew_seconds", {"layer": F.col("layer"), "dataset": F.col("dataset")},
        F.abs(F.col("written_at_epoch") - F.col("at")))


def latest(rows: DataFrame, date: str = "date") -> DataFrame:
    """The rows of the latest date alone."""
    top = rows.agg(F.max(date).alias("_top"))
    return rows.join(F.broadcast(top), F.col(date) == F.col("_top")).drop("_top")


class LastGood:
    """The last snapshot that could be made, and how often making one failed since the start."""

    def __init__(self) -> None:
        self.rows: list = []
        self.errors = 0
        self.made_at: float | None = None

    def refresh(self, make, now: float) -> list:
        """``make()`` a frame and keep its rows; if that fails, count it and serve the last ones."""
        try:
            self.rows, self.made_at = make().collect(), now
        except Exception:
            self.errors += 1
        return self.rows


def observed(rows: DataFrame, by: list[str], value: str, bounds: list[float]) -> DataFrame:
    """Observations as a histogram: ``(*by, le, n)`` with cumulative counts, ``le`` null for infinity, as quantiles take it."""
    steps = F.array(*[F.struct(F.lit(float(b)).alias("le"), (F.col(value) <= b).cast("long").alias("in")) for b in bounds],
                    F.struct(F.lit(None).cast("double").alias("le"), F.lit(1).cast("long").alias("in")))
    tall = rows.where(F.col(value).isNotNull()).select(*by, F.explode(steps).alias("s"))
    return tall.groupBy(*by, F.col("s.le").alias("le")).agg(F.sum("s.in").alias("n"))
