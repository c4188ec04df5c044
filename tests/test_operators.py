"""Operators on small fixtures: percentiles, carried windows, features and their grammar, folds, models, runs, gauges, the lake."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymark.operators import asof, book, features, grammar, metrics, quantiles, research, runs, scorecard, silver
from quaymark.plans import gold, market
from quaymark.plans import research as plans
from quaymark.sources import lake

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("small", [0, 100_000])
def test_percentiles_are_numpy_s(spark, small):
    rng = np.random.default_rng(0)
    groups = {"a": rng.standard_normal(500).tolist(), "b": [1.0] * 40, "c": [3.0], "d": [float(x) for x in rng.integers(0, 4, 300)],
        "e": [1e300, -1e300, 0.0, float("inf")], None: [2.0, 5.0]}
    rows = [(k, x) for k, xs in groups.items() for x in xs] + [("a", None), ("f", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(3)
    shares = [0.0, 0.01, 0.5, 0.95, 1.0]
    got = {r.k: r.p for r in quantiles.percentiles(df, ["k"], "x", shares, bins=16, small=small).collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        if k != "e":
            assert got[k] == pytest.approx(np.percentile(xs, [100 * s for s in shares]).tolist(), rel=1e-12, abs=1e-12)
    whole = quantiles.percentiles(df.where("k <> 'e'"), [], "x", [0.5], small=small).first().p[0]
    assert whole == pytest.approx(np.percentile([x for k, x in rows if x is not None and k not in ("e", None)], 50))
    assert quantiles.percentiles(df.limit(0), ["k"], "x", shares, small=small).collect() == []


def test_shards_change_nothing(spark):
    q = market.quotes(spark, SF)
    plain = asof.nbbo(q, market.VENUES, None)
    for shard in (market.H, 50 * market.H):
        assert sorted(map(tuple, asof.nbbo(q, market.VENUES, None, shard_ns=shard).collect())) == sorted(map(tuple, plain.collect()))
    grid = features.grid(q, ["symbol", "venue"], "ts_ns", market.H)
    a, b = (asof.asof_join(grid, q, ["symbol", "venue"], "ts_ns", ["arrival"], ["bid"], shard_ns=s) for s in (None, 7 * market.H))
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_matrix_has_the_columns_of_its_grammar(spark):
    m = plans.matrix(spark, SF)
    g = grammar.Grammar(m.columns)
    assert set(g.columns) == set(m.columns) and g.missing() == {} and g.venues == ["click", "error", "view"]
    assert g.streams["view"] == {"quotes", "trades", "mark_price", "open_interest", "liquidations"}
    inputs = g.features(m.columns, without="view")
    assert "click_ofi" in inputs and not any(c.startswith(("view", "nbbo", "y_")) for c in inputs) and "click_mid" not in inputs
    book_ages, tape_ages = g.ages()
    assert book_ages == ["click_age_ms", "error_age_ms", "view_age_ms"] and set(tape_ages) == {"nbbo_age_ms", "view_mark_age_ms",
        "view_oi_age_ms"}
    assert grammar.Grammar(c for c in m.columns if c != "view_vwap").missing() == {"view/flow": ["view_vwap"]}
    rows = m.orderBy("ts_ns").collect()
    assert len(rows) == len({(r.date, r.ts_ns) for r in rows}) and any(r.y_ret_bps_1 is not None
        for r in rows) and any(r.view_ofi_5 is not None for r in rows)
    kept = features.clean(m, g.target(1), g.tolerances(3_600_000, 4 * 3_600_000))
    assert 0 < kept.count() < len(rows)


def test_grammar_reads_the_longest_tail():
    assert grammar.classify("binance_futures_oi_age_ms") == grammar.Named("binance_futures_oi_age_ms", "open_interest", "diagnostic",
        "binance_futures")
    assert grammar.classify("y_a_b_dz_5").venue == "a_b" and grammar.classify("y_dz_5").venue is None
    for bad in ("what", "y_coinbase_mid", "_mid"):
        with pytest.raises(ValueError):
            grammar.classify(bad)
    with pytest.raises(ValueError, match="collide"):
        grammar.expected({"a": ["mark_price", "quotes"], "a_mark": ["quotes"]})
    assert grammar.Grammar(["a_mid"]).spread("a") == "a_spread_bps" and grammar.Grammar(["a_mid"]).target(5, "a") == "y_a_ret_bps_5"


def test_feature_rules(spark):
    assert [features.window_tolerance(w, 5000, 1000) for w in (1, 30, 300)] == [5000, 5000, 30_000]
    q = spark.createDataFrame([("x-y", "A"), ("x-y", "B"), ("z", "A")], "exchange string, symbol string")
    with pytest.raises(ValueError, match="both"):
        features.legs(q, ["A", "B"])
    assert features.legs(q, ["A"]) == [("x_y", "A", "x-y"), ("z", "A", "z")]
    none = features.depth_shape(["bid"], F.lit(1.0))
    assert spark.range(1).select(none["depth_imb_5"].alias("a"), none["depth_10"].alias("b")).first() == (None, None)
    oi = spark.createDataFrame([(2.0, 1.0), (2.0, 0.0), (None, 1.0)],
        "a double, b double").select(features.oi_change_bps(F.col("a"), F.col("b")))
    assert [r[0] for r in oi.collect()] == [10_000.0, None, None]
    aged = spark.createDataFrame([(1.0, 4.0), (1.0, None), (1.0, 6.0), (None, 1.0)], "y double, age double")
    assert features.clean(aged, "y", {"age": 5}).count() == 2


def test_kraken_checksum(spark):
    import zlib

    lv = "array<struct<px:string,sz:string>>"
    df = spark.createDataFrame([([("0.05005", "0.00000500"), ("10", "2.5")], [("9.9", "1")])], f"asks {lv}, bids {lv}")
    assert df.select(book.kraken_checksum(F.col("bids"), F.col("asks"))).first()[0] == zlib.crc32(b"5005500" + b"1025" + b"991")


def test_fold_embargoes(spark):
    rows = spark.createDataFrame([(f"d{d}", d * 1000 + i) for d in range(4) for i in range(40)], "date string, ts_ns long")
    parts = research.fold_rows(rows, ["d0", "d1", "d2"], ["d3"], 5).orderBy("ts_ns").collect()
    got = [r.part for r in parts]
    n_val = round(115 * 0.15)
    assert got == ["fit"] * (115 - n_val - 5) + [None] * 5 + ["val"] * n_val + [None] * 5 + ["test"] * 40
    assert research.last_dates(["a"]) == ([], []) and research.last_dates(list("abcdefghij")) == (list("abcdefg"), list("hij"))


def test_intervals_are_the_draws_of_the_seed(spark):
    rng = np.random.default_rng(0)
    rows = [(f"d{i % 6}", float(y), float(p), 0.5) for i, (y, p) in enumerate(rng.standard_normal((300, 2)))]
    got = {(r.family, r.metric): r
        for r in research.intervals(spark.createDataFrame(rows, "date string, y double, p double, threshold double"), share=0.4,
        draws=300).collect()}
    dates = sorted({r[0] for r in rows})
    picks = np.random.default_rng(0).integers(0, 6, (300, 6))
    per = {d: [r for r in rows if r[0] == d] for d in dates}

    def r2(rs):
        return 1 - sum((r[1] - r[2]) ** 2 for r in rs) / sum(r[1] ** 2 for r in rs)

    stats = [r2([r for j in row for r in per[dates[j]]]) for row in picks]
    g = got["returns", "r2"]
    assert g.point == pytest.approx(r2(rows)) and [g.lo, g.hi] == pytest.approx(np.percentile(stats, [2.5, 97.5]).tolist())
    cut = np.quantile([abs(r[2]) for r in rows], 0.6)
    calls = [r for r in rows if r[2] > cut]
    assert got["coverage", "up_precision"].point == pytest.approx(sum(r[1] > 0.5 for r in calls) / len(calls))
    one = research.intervals(spark.createDataFrame([r for r in rows if r[0] == "d0"], "date string, y double, p double, threshold double"),
        draws=10)
    assert all(r.lo is None for r in one.collect())


def test_boosted_trees_learn_and_stay_upward(spark):
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (1500, 2))
    y = np.sign(x[:, 0]) + 0.3 * np.sin(6 * x[:, 0]) + (x[:, 1] > 0.2)
    rows = [(None if i % 13 == 0 else float(a), float(b), float(t)) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "k_ofi double, other double, y double").coalesce(2)
    model = research.Boosted(["k_ofi", "other"], rounds=8, rate=0.5, depth=3, least=20, bins=16).fit(df)
    err = model.predict(df).agg(F.avg((F.col("y") - F.col("p")) ** 2)).first()[0]
    assert err < 0.3 * np.var(y)
    line = spark.createDataFrame([(float(v), 0.0) for v in np.linspace(-1, 1, 41)], "k_ofi double, other double")
    p = [r.p for r in model.predict(line).orderBy("k_ofi").collect()]
    assert all(b >= a - 1e-12 for a, b in zip(p, p[1:])) and p[-1] > p[0] + 1
    short = research.Boosted(["other"], rounds=30, rate=1.0, depth=1, least=20, patience=2).fit(df.where("y > 0"), df.where("y < 0"))
    assert len(short.trees) < 30


def test_importance_finds_the_feature(spark):
    rng = np.random.default_rng(1)
    rows = [(float(a), float(b), float(a)) for a, b in rng.standard_normal((300, 2))]
    df = spark.createDataFrame(rows, "a double, b double, y double").coalesce(1)
    got = {r.venue: r.importance for r in research.permutation_importance(df, lambda d: d.withColumn("p", F.col("a")), ["a", "b"],
        {"a": "x", "b": "z"}, 2).collect()}
    assert got["x"] > 1 and got["z"] == pytest.approx(0)


def test_a_placebo_kills_an_edge_and_not_a_leak(spark):
    rng = np.random.default_rng(2)
    rows = [(f"d{d:02}", i, float(f), float(f + 0.3 * e)) for d in range(12) for i, (f, e) in enumerate(rng.standard_normal((60, 2)))]
    df = spark.createDataFrame(rows, "date string, ts_ns long, x_ofi double, y double")

    def score(d):
        beta, icept = research.ridge(d, ["x_ofi"], "y")
        return research.evaluate(research.linear(beta, icept, ["x_ofi"], {})(d)).first().r2

    assert score(df) > 0.8 and score(research.placebo(df, "y", 20, ["date"], "ts_ns").where("y is not null")) < 0.05


def test_runs_are_held_against_each_other(spark, tmp_path):
    prov = runs.provenance("2024-01-02T03:04:05+00:00", b"builder", ["a", "b"], {"d": "x"}) | {"git_dirty": False, "git_sha": "abc"}
    spec = dict.fromkeys(runs.EXPERIMENT, 1) | {"predict_venue": "a", "placebo": False}
    oos = spark.createDataFrame([(0, m, "d", t, 1.0, p) for t in (1, 2) for m, p in (("zero", 0.0), ("gbt", 0.5))],
        "fold int, model string, date string, ts_ns long, y double, p double")
    make = lambda name, **more: runs.write_run(spark, str(tmp_path / name), {"spec": spec | more, "provenance": prov, "score": math.nan},
        oos)
    real, placebo, other = make("r"), make("p", placebo=True), make("o", predict_venue="b", target=2)
    assert runs.read_run(spark, real)["score"] is None
    assert sorted(map(tuple, runs.tall(spark.read.parquet(f"{real}/oos")).collect())) == sorted(map(tuple, oos.collect()))
    assert len(runs.export(spark, str(tmp_path / "out"), real, placebo, other)) == 6
    for bad in ({"placebo": real}, {"placebo": make("q", placebo=True, horizon=9)}, {"reverse": real},
        {"reverse": make("s", predict_venue="b", horizon=9)}):
        with pytest.raises(ValueError):
            runs.export(spark, str(tmp_path / "no"), real, **bad)
    dirty = runs.read_run(spark, real)
    dirty["provenance"]["git_dirty"] = True
    with pytest.raises(ValueError, match="dirty"):
        runs.check(dirty)
    runs.check(dirty, allow_dirty=True)
    shown = runs.report(spark.createDataFrame([("gbt", 0.1, None)], "model string, mean double, std double"),
        spark.createDataFrame([("returns", "r2", 0.1, None, 0.2)], "family string, metric string, point double, lo double, hi double"),
        {"x/flow": ["x_vwap"]})
    assert shown == ["returns   r2              0.10000 [-, 0.20000]", "gbt         R2 over folds 0.10000 +/- -",
        "missing in x/flow: x_vwap"]


def test_the_lake_lists_prunes_and_marks(spark, tmp_path):
    base = str(tmp_path / "lake")
    assert lake.partitions(spark, base, "silver", "nbbo") == [] and lake.latest_date(spark, base, "silver", "nbbo") is None
    rows = [("A", d, i, 1, 2, "x", "y", 2) for d in ("2024-01-01", "2024-01-02") for i in range(3)]
    df = spark.createDataFrame([(s, d, i, None, None, x, y, n) for s, d, i, _, _, x, y, n in rows], lake.SCHEMAS["silver", "nbbo"])
    lake.write(df, base, "silver", "nbbo", ["canonical_symbol", "date"])
    assert lake.partitions(spark, base, "silver", "nbbo") == [{"canonical_symbol": "A", "date": "2024-01-01"},
        {"canonical_symbol": "A", "date": "2024-01-02"}]
    assert lake.latest_date(spark, base, "silver", "nbbo") == "2024-01-02"
    one = lake.read(spark, base, "silver", "nbbo", date="2024-01-02", canonical_symbol="A")
    assert one.count() == 3 and one.columns == lake.schema("silver", "nbbo").names
    assert "PartitionFilters: [isnotnull(p_date" in one._jdf.queryExecution().toString()
    marks = lake.read_markers(spark, base, "silver")
    assert sorted((r.dataset, r.date, r.row_count) for r in marks.collect()) == [("nbbo", "2024-01-01", 3), ("nbbo", "2024-01-02", 3)]
    newest = lake.newest_files(spark, base, "silver", ["nbbo", "quotes"])
    skew = metrics.marker_skew(lake.layer_at(spark, base, "silver", ["nbbo"]).withColumnRenamed("at", "written_at_epoch"), newest).first()
    assert skew.labels == {"layer": "silver", "dataset": "nbbo"} and 0 <= skew.value < 120
    assert lake.read_markers(spark, base, "gold").collect() == []
    assert len(lake.SCHEMAS) == 21 and lake.decimals("silver", "nbbo") == ["best_bid", "best_ask"] and lake.drifted(lake.contract("gold"),
        "gold") == []
    assert lake.drifted(lake.contract("gold").replace("n_obs", "n"), "gold")
    with pytest.raises(KeyError):
        lake.schema("gold", "nbbo")
    assert lake.roots({"lake.root": "a", "lake.bronze.root": "b"}) == {"bronze": "b", "silver": "a", "gold": "a"}
    with pytest.raises(ValueError):
        lake.roots({})
    digest = runs.fingerprint(spark, base, "2024-01-02", ["A"], ["nbbo"])
    assert digest == runs.fingerprint(spark, base, "2024-01-02", ["A"], ["nbbo", "quotes"]) != runs.fingerprint(spark, base, "2024-01-02",
        ["B"], ["nbbo"])
    built = []
    make = lambda: (built.append(1), df)[1]
    for _ in range(2):
        assert runs.cached(spark, str(tmp_path / "cache"), "m", digest, "b1", make).count() == 6
    assert len(built) == 1


def test_scorecard_gate_and_gauges(spark):
    card = gold.card(spark, SF)
    rules = spark.createDataFrame(scorecard.load_budget(gold.BUDGET), scorecard.RULES)
    failed = scorecard.breaches(card.withColumnRenamed("canonical_symbol", "symbol"), rules)
    assert scorecard.gate(failed) == 1 and scorecard.gate(failed, False) == 0 and scorecard.gate(failed.limit(0)) == 0
    two = spark.createDataFrame([("x", "s", d, "coverage", 1, 5, None) for d in ("d1", "d2")],
        "exchange string, symbol string, date string, check string, n_records long, n_violations long, p99_ms double")
    got = scorecard.breaches(two, spark.createDataFrame(scorecard.budget_rules({}), scorecard.RULES)).collect()
    assert sorted((r.date, r.limit, r.value) for r in got) == [("d1", "max_violations", 5.0), ("d2", "max_violations", 5.0)]
    last = metrics.LastGood()
    assert last.refresh(lambda: spark.range(2), 1.0) == [(0,), (1,)] and last.refresh(lambda: spark.range(1).select("nope"), 2.0) == [(0,),
        (1,)] and last.errors == 1


def test_alert_needs_its_time(spark):
    rule = [("Down", "up", "value", 0, None, "==", 0.0, 60)]
    rows = [("up", {"i": "a"}, t, v) for t, v in ((0, 1.0), (30, 0.0), (60, 0.0), (90, 0.0), (120, 1.0), (150, 0.0))]
    got = metrics.alerts(spark.createDataFrame(rows, "metric string, labels map<string,string>, ts long, value double"),
        rule).orderBy("ts").collect()
    assert [r.firing for r in got] == [False, False, False, True, False, False] and got[0].series == '{"i":"a"}'
    assert len(metrics.ALERTS) == 14


def test_spans_are_summed_without_sliding_frames(spark):
    """A sliding frame adds its rows anew for each row: dense series took the square of their rows."""
    rng = np.random.default_rng(5)
    ts = [int(t) for t in rng.choice(np.arange(-300, 300), 150, replace=False)]
    rows = [(k, t, float(v)) for k in "ab" for t, v in zip(ts, rng.choice([0.1, 0.3, 7.0, 1e17], len(ts)))] + [("c", 5, float("inf")), ("c", 8, 1.0), ("c", 11, 3.0), ("c", None, 4.0)]
    df = spark.createDataFrame(rows, "k string, ts long, v double")
    for span in (1, 2, 7, 50, 1000):
        got = metrics.increase(df, ["k"], "ts", "v", span)
        moved = metrics.changes(df, ["k"], "ts", "v", span)
        for frame, name in ((got, "increase"), (moved, "changes")):
            assert "RangeFrame, -" not in frame._jdf.queryExecution().analyzed().toString()
            assert frame.columns == ["k", "ts", "v", name] and frame.count() == len(rows)
        up, turned = ({(r.k, r.ts): r[3] for r in f.collect()} for f in (got, moved))
        for k in "ab":
            own = sorted((t, v) for n, t, v in rows if n == k)
            steps = [(own[i][0], own[i][1] if own[i][1] < own[i - 1][1] else own[i][1] - own[i - 1][1], own[i][1] != own[i - 1][1]) if i else (own[0][0], 0.0, False) for i in range(len(own))]
            for t, _ in own:
                inside = [s for s in steps if t - span < s[0] <= t]
                assert up[k, t] == pytest.approx(sum(s[1] for s in inside), rel=1e-12) and turned[k, t] == sum(s[2] for s in inside)
        if span == 2:
            assert up["c", 11] == 2.0  # what has left the span leaves nothing behind


def test_alerts_read_no_sliding_frames(spark):
    board = gold.alert_board(spark, SF)
    assert "RangeFrame, -" not in board._jdf.queryExecution().analyzed().toString()
    twice = [("A", "m", "value", 0, None, ">", 1.0, 0), ("A", "m", "value", 0, ("i",), ">", 3.0, 10)]
    df = spark.createDataFrame([("m", {"i": "a", "b": "x"}, t, float(t)) for t in (2, 4, 14)], "metric string, labels map<string,string>, ts long, value double")
    got = sorted((r.series, r.ts, r.active, r.firing) for r in metrics.alerts(df, twice).collect())
    assert got == [('{"b":"x","i":"a"}', 2, True, True), ('{"b":"x","i":"a"}', 4, True, True), ('{"b":"x","i":"a"}', 14, True, True),
        ('{"i":"a"}', 2, False, False), ('{"i":"a"}', 4, True, False), ('{"i":"a"}', 14, True, True)]


def test_samples_of_one_time_are_one_evaluation(spark):
    rules = [("V", "m", "value", 0, None, ">", 1.0, 5), ("M", "m", "max", 0, ("i",), ">", 1.0, 5), ("L", "m", "min", 0, (), ">", 1.0, 5)]
    rows = [("m", {"i": "a"}, t, v) for t, v in ((1, 2.0), (1, 0.0), (1, None), (6, 0.0), (6, 3.0), (9, None), (9, None), (12, 1.0), (None, 4.0), (None, 5.0))]
    df = spark.createDataFrame(rows, "metric string, labels map<string,string>, ts long, value double")
    got = {(r.alert, r.ts): (r.value, r.active) for r in metrics.alerts(df, rules).collect()}
    high = {None: (5.0, True), 1: (2.0, True), 6: (3.0, True), 9: (None, False), 12: (1.0, False)}
    low = high | {None: (4.0, True), 1: (0.0, False), 6: (0.0, False)}
    assert got == {(n, t): v for n, want in (("V", high), ("M", high), ("L", low)) for t, v in want.items()}
    assert metrics.alerts(df, rules).count() == len(got)


def test_decode_feeds_tape_and_latency(spark):
    from quaymark.sources import wire

    value = b'{"t":"trade","exchange":"x","symbol":"A/B","trade_id":"7","price":"1.5","size":"2","side":"bid","exchange_ts_ns":10,"local_ts_ns":30}'
    r = spark.createDataFrame([("md.trades.x.A-B", 0, 5, 1_700_000_000_000, None, value, [("local_recv_ts_ns", b"20")])], wire.RECORD)
    ref = spark.createDataFrame([("A-B", "A", "B", "x", "A/B")],
        "canonical string, base string, quote string, exchange string, symbol string")
    d = silver.decoded(r, ref, "trades")
    t, lat = silver.tape(d, "trades").first(), silver.latency(d).first()
    assert (t.canonical_symbol, t.ts_ns, str(t.price)[:4], t.side) == ("A-B", 20, "1.50", "bid") and (lat.exchange_to_recv_ns,
        lat.exchange_to_emit_ns) == (10, 20)
    assert silver.no_regression(spark.createDataFrame([(1, 5), (2, 6)], "n long, ts_ns long").withColumn("k", F.lit(1)), ["k"], "n",
        "ts_ns").count() == 2
    with pytest.raises(Exception, match="goes back"):
        silver.no_regression(spark.createDataFrame([(1, 5), (2, 4)], "n long, ts_ns long").withColumn("k", F.lit(1)), ["k"], "n",
            "ts_ns").collect()


def test_columns_of_families_meet_by_date(spark):
    a, b = spark.createDataFrame([("d1", 1)], "date string, x long"), spark.createDataFrame([("d2", 2)], "date string, y long")
    assert a.unionByName(b, allowMissingColumns=True).orderBy("date").collect() == [("d1", 1, None), ("d2", None, 2)]
