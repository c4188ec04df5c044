"""Data-quality scorecard rows, absent partitions, and budgets."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Names of checks and of limits.
CHECKS = ("sequence_gap", "book_invariant", "coverage", "clock_monotonic", "venue_uptime")
LIMITS = ("max_violations", "max_rate", "min_records", "max_p99_ms")


def sequence_gap(deltas: DataFrame, by: list[str]) -> DataFrame:
    """``deltas(..., seq_gap)``: records, gaps, missing sequences and the largest gap."""
    return deltas.groupBy(*by).agg(F.count("*").alias("n_records"), F.count_if(F.col("seq_gap") > 0).alias("n_violations"),
        F.sum("seq_gap").alias("total_missing"), F.max("seq_gap").alias("max_gap"))


def invariants(events: DataFrame, by: list[str]) -> DataFrame:
    """``events(..., invariant_kind, crossed, locked)``: violations, by kind, and locked ones."""
    return events.groupBy(*by).agg(F.count("*").alias("n_records"), F.count("invariant_kind").alias("n_violations"),
                                   F.count_if(F.col("crossed")).alias("n_crossed"),
                                   F.count_if(F.col("crossed") & F.col("locked")).alias("n_locked"))


def clock(deltas: DataFrame, by: list[str], order: list[str], recv: str, epoch: str) -> DataFrame:
    """Backward steps of the receive clock between deltas in fold order, within and across epochs.

    All deltas count; those without a receive time are passed over."""
    w = Window.partitionBy(*by).orderBy(*order)
    known = deltas.where(F.col(recv).isNotNull()).withColumn("_r", F.lag(recv).over(w)).withColumn("_e", F.lag(epoch).over(w))
    back = F.col(recv) < F.col("_r")
    steps = known.groupBy(*by).agg(F.count_if(back & (F.col("_e") == F.col(epoch))).alias("n_violations"),
        F.count_if(back & (F.col("_e") != F.col(epoch))).alias("inter_epoch_steps"),
                                   F.coalesce(F.max(F.when(back & (F.col("_e") == F.col(epoch)), F.col("_r") - F.col(recv))),
                                   F.lit(0)).alias("worst_ns"))
    return deltas.groupBy(*by).agg(F.count("*").alias("n_records")).join(steps, by, "left").na.fill(0)


def latency(rows: DataFrame, by: list[str], ns: str) -> DataFrame:
    """Exact p50, p95, p99 and maximum in milliseconds."""
    from .quantiles import percentiles

    whole = rows.groupBy(*by).agg(F.count("*").alias("n_records"), F.max(F.col(ns) / 1e6).alias("max_ms"))
    p = percentiles(rows.withColumn("_ms", F.col(ns) / 1e6), by, "_ms", [0.5, 0.95, 0.99])
    same = [F.col(f"w.{c}").eqNullSafe(F.col(f"p.{c}")) for c in by]
    met = whole.alias("w").join(p.alias("p"), reduce(Column.__and__, same))
    return met.select(*[f"w.{c}" for c in by], "n_records", F.col("p")[0].alias("p50_ms"), F.col("p")[1].alias("p95_ms"),
        F.col("p")[2].alias("p99_ms"), "max_ms")


def transitions(status: DataFrame, by: list[str], ts: str, order: str, state: str = "state") -> DataFrame:
    """``prev_state``, ``is_transition`` and, on coming up, the downtime since the last down."""
    w = Window.partitionBy(*by).orderBy(ts, order)
    prev, since = F.lag(state).over(w), F.lag(ts).over(w)
    return (status.withColumn("prev_state", prev).withColumn("is_transition", F.coalesce(F.col("prev_state") != F.col(state), F.lit(False)))
            .withColumn("downtime_ns", F.when((F.col("prev_state") == "down") & (F.col(state) == "up"), F.col(ts) - since)))


def uptime(trans: DataFrame, by: list[str], ts: str, order: str, state: str = "state") -> DataFrame:
    return trans.groupBy(*by).agg(F.count_if("is_transition").alias("transitions"),
        F.count_if(F.col("is_transition") & (F.col(state) == "down")).alias("n_violations"),
                                  F.sum(F.coalesce("downtime_ns", F.lit(0))).alias("downtime_ns"),
                                  F.max_by(state, F.struct(ts, order)).alias("final_state"))


def absent(seen: DataFrame, expected: DataFrame, by: list[str]) -> DataFrame:
    """Coverage rows for declared partitions that have none."""
    missing = expected.join(seen.select(*by).distinct(), by, "left_anti")
    return missing.select(*by, F.lit("coverage").alias("check"), F.lit(0).cast("long").alias("n_records"),
        F.lit(1).cast("long").alias("n_violations"))


def budget_rules(doc: Mapping[str, Any]) -> list[tuple]:
    """A budget tree as rules ``(check_key, exchange, symbol, rank, limits...)``, least specific first.

    Unknown keys, unknown checks and limits that are no non-negative numbers are errors."""
    def numbers(node: Mapping[str, Any], where: str, allowed: set[str]) -> tuple:
        if unknown := set(node) - allowed - set(LIMITS):
            raise ValueError(f"unknown {sorted(unknown)} at {where}")
        for k in LIMITS:
            v = node.get(k)
            if v is not None and (isinstance(v, bool) or not isinstance(v, (int, float)) or v < 0):
                raise ValueError(f"{where}.{k} must be a non-negative number")
        return tuple(None if node.get(k) is None else float(node[k]) for k in LIMITS)

    if unknown := set(doc) - {"default", "checks"}:
        raise ValueError(f"unknown {sorted(unknown)}")
    base = numbers(doc.get("default") or {}, "default", set())
    out = [("*", None, None, 0, 0.0 if base[0] is None else base[0], *base[1:])]
    for check, node in (doc.get("checks") or {}).items():
        node = node or {}
        family = check == "latency"
        if not (check in CHECKS or family or check.startswith("latency.")):
            raise ValueError(f"unknown check {check}")
        out.append((check, None, None, 1 if family else 2, *numbers(node, check, {"exchanges"})))
        for ex, scope in (node.get("exchanges") or {}).items():
            scope = scope or {}
            out.append((check, ex, None, 3 if family else 4, *numbers(scope, f"{check}.{ex}", {"symbols"})))
            for symbol, leaf in (scope.get("symbols") or {}).items():
                out.append((check, ex, symbol, 5 if family else 6, *numbers(leaf or {}, f"{check}.{ex}.{symbol}", set())))
    return out


RULES = "check_key string, rule_exchange string, rule_symbol string, rank int, max_violations double, max_rate double, min_records double, max_p99_ms double"


def breaches(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """One row per limit that a scorecard row fails: ``(exchange, symbol, date, check, limit, value, bound)``.

    ``rows(exchange, symbol, date, check, n_records, n_violations, p99_ms)``. Each limit is that of the
    most specific rule that has it; the default holds where no node names the check. Every
    row is held to its limits by itself, so that equal counts on two dates are two breaches."""
    r = rows.select("exchange", "symbol", "date", "check", "n_records", "n_violations", "p99_ms").withColumn("_row",
        F.monotonically_increasing_id())
    family = F.col("check").startswith("latency.") & (F.col("check_key") == "latency")
    names = (F.col("check_key") == F.col("check")) | family
    scope = (F.col("rule_exchange").isNull() | (F.col("rule_exchange") == F.col("exchange"))) & (F.col("rule_symbol").isNull()
        | (F.col("rule_symbol") == F.col("symbol")))
    # the rules are a budget file: as many rows as it has lines
    met = r.join(F.broadcast(rules), ((F.col("check_key") == "*") | names) & scope, "left")
    named = F.max((F.col("check_key") != "*").cast("int")) == 1
    keep = [c for c in r.columns if c != "_row"]
    ranked = [F.max_by(k, F.when(F.col(k).isNotNull() & (F.col("check_key") != "*"), F.col("rank"))).alias(f"own_{k}") for k in LIMITS]
    default = [F.max(F.when(F.col("check_key") == "*", F.col(k))).alias(f"default_{k}") for k in LIMITS]
    lim = met.groupBy("_row").agg(named.alias("named"), *[F.first(c).alias(c) for c in keep], *ranked, *default)
    lim = lim.select(*keep, *[F.when(F.col("named"), F.col(f"own_{k}")).otherwise(F.col(f"default_{k}")).alias(k) for k in LIMITS])
    n, v, p = (F.coalesce("n_records", F.lit(0)), F.coalesce("n_violations", F.lit(0)), F.col("p99_ms"))
    tests = [("max_violations", v.cast("double"), v > F.col("max_violations")),
        ("max_rate", F.try_divide(v, n), (n > 0) & (F.try_divide(v, n) > F.col("max_rate"))),
             ("min_records", n.cast("double"), n < F.col("min_records")), ("max_p99_ms", p, p > F.col("max_p99_ms"))]
    failed = F.filter(F.array(*[F.when(t, F.struct(F.lit(k).alias("limit"), x.alias("value"), F.col(k).alias("bound"))) for k, x,
        t in tests]), lambda x: x.isNotNull())
    return lim.withColumn("b", F.explode(failed)).select("exchange", "symbol", "date", "check", "b.limit", "b.value", "b.bound")


def load_budget(text: str) -> list[tuple]:
    """The rules of a budget file in YAML; what :func:`budget_rules` rejects fails here, at load."""
    import yaml

    doc = yaml.safe_load(text) or {}
    if not isinstance(doc, Mapping):
        raise ValueError("a budget is a mapping")
    return budget_rules(doc)


def gate(failed: DataFrame, fail_on_violation: bool = True) -> int:
    """The exit code of a build: 1 if any limit is broken and that is to fail it."""
    return int(fail_on_violation and not failed.isEmpty())


def _detail(**parts: Column) -> Column:
    """A JSON object with its keys in order."""
    return F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)]))


ROW = ["exchange", "canonical_symbol", "date", "check", "n_records", "n_violations", "p50_ms", "p95_ms", "p99_ms", "detail"]


def _rows(df: DataFrame, check: Column) -> DataFrame:
    """Scorecard rows from ``df``, with nulls for what a check does not measure."""
    have = set(df.columns)
    none = {"canonical_symbol": F.lit(None).cast("string"), "n_violations": F.lit(0).cast("long"),
        **{f"{q}_ms": F.lit(None).cast("double") for q in ("p50", "p95", "p99")}}
    return df.withColumn("check", check).select(*[F.col(c) if c in have or c == "check" else none[c].alias(c) for c in ROW])


def scorecard(book: DataFrame, latencies: DataFrame, status: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """The day's data quality: a row per partition and check, from the three streams of facts.

    ``book(exchange, canonical_symbol, date, kind, epoch, local_recv_ts_ns, best_bid, best_ask, seq_gap, crossed,
    invariant_kind, offset)`` in fold order by (epoch, sequence, offset); ``latencies(..., dataset,
    exchange_to_emit_ns)``; ``status(exchange, date, ts_ns, offset, state, is_transition, downtime_ns)``;
    ``expected(exchange, canonical_symbol)``: declared partitions, which get a coverage row with no records
    on each date that has any row at all."""
    by = ["exchange", "canonical_symbol", "date"]
    delta = F.col("kind") == "delta"
    gaps = book.groupBy(*by).agg(
        F.count_if(delta).alias("n_records"), F.count_if(delta & (F.col("seq_gap") > 0)).alias("n_violations"),
        F.coalesce(F.sum(F.when(delta & (F.col("seq_gap") > 0), F.col("seq_gap"))), F.lit(0)).alias("missing"),
        F.coalesce(F.max(F.when(delta & (F.col("seq_gap") > 0), F.col("seq_gap"))), F.lit(0)).alias("largest"))
    kinds = book.groupBy(*by, "invariant_kind").agg(
        F.count("*").alias("n"), F.count_if(delta).alias("deltas"),
        F.count_if(F.col("crossed") & (F.col("best_bid") == F.col("best_ask"))).alias("locked"))
    named = F.collect_list(F.when(F.col("invariant_kind").isNotNull(), F.struct("invariant_kind", "n")))
    broken = F.col("invariant_kind").isNotNull()
    whole = kinds.groupBy(*by).agg(
        F.sum("n").alias("n_records"), F.coalesce(F.sum(F.when(broken, F.col("n"))), F.lit(0)).alias("n_violations"),
        F.sum("deltas").alias("deltas"),
        F.coalesce(F.sum(F.when(broken, F.col("locked"))), F.lit(0)).alias("locked"), named.alias("kinds"))
    tally = F.map_from_entries(F.array_sort(F.concat("kinds",
        F.array(F.struct(F.lit("locked").alias("invariant_kind"), F.col("locked").alias("n"))))))
    order = ["epoch", "sequence", "offset"]
    steps = clock(book.where(delta), by, order, "local_recv_ts_ns", "epoch")
    quiet = whole.where("deltas = 0").select(*by, F.lit(0).cast("long").alias("n_records"), F.lit(0).cast("long").alias("n_violations"),
                                             F.lit(0).cast("long").alias("inter_epoch_steps"), F.lit(0).cast("long").alias("worst_ns"))
    lat = latency(latencies, [*by, "dataset"], "exchange_to_emit_ns")
    up = uptime(status, ["exchange", "date"], "ts_ns", "offset")
    seen = status.groupBy("exchange", "date").agg(F.count("*").alias("n_records"))
    parts = [
        _rows(gaps.withColumn("detail", _detail(total_missing=F.col("missing"), max_gap=F.col("largest"))), F.lit("sequence_gap")),
        _rows(whole.withColumn("detail", F.to_json(tally)), F.lit("book_invariant")),
        _rows(whole.drop("n_violations").withColumn("detail", _detail(snapshots=F.col("n_records") - F.col("deltas"),
        deltas=F.col("deltas"))), F.lit("coverage")),
        _rows(steps.select(*quiet.columns).unionByName(quiet).withColumn("detail",
        _detail(worst_lateness_ms=F.col("worst_ns") / 1e6, inter_epoch_steps=F.col("inter_epoch_steps"))), F.lit("clock_monotonic")),
        _rows(lat.withColumn("detail", _detail(max_ms=F.col("max_ms"))), F.concat(F.lit("latency."), F.col("dataset"))),
        _rows(up.join(seen, ["exchange", "date"]).withColumn("detail", _detail(
            transitions=F.col("transitions"), down_transitions=F.col("n_violations"), downtime_sec=F.col("downtime_ns") / 1e9,
            final_state=F.col("final_state"))), F.lit("venue_uptime")),
    ]
    out = reduce(DataFrame.unionByName, parts)
    if expected is not None:
        dates = out.select("date").distinct()
        want = expected.select("exchange", "canonical_symbol").distinct().join(F.broadcast(dates),
            F.lit(True))  # declared pairs by the dates of a build
        gone = absent(out.where("canonical_symbol is not null"), want, by).withColumn("n_violations", F.lit(0).cast("long"))
        out = out.unionByName(_rows(gone.drop("check").withColumn("detail", F.lit('{"absent":true}')), F.lit("coverage")))
    return out


def rules_frame(spark: SparkSession, doc: Mapping[str, Any]) -> DataFrame:
    return spark.createDataFrame(budget_rules(doc), RULES)
