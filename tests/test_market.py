"""Reference operators: unit fixtures, and every query against its SQL twin on the smallest tables."""

from decimal import Decimal
from types import SimpleNamespace as N

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quaymark import plans
from quaymark.operators import asof, book, features, metrics, research, scorecard
from quaymark.plans import market
from quaymark.sources import lake, wire
from quaymark.streaming import gateway

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in ("events", "lineitem"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr(tuple(r[i] for i in order)) for r in rows)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_matches_sql(spark, duck, name):
    df = plans.QUERIES[name](spark, SF)
    cur = duck.execute(plans.SQL[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of([d[0] for d in cur.description], cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.SQL)))
def test_query_without_a_twin_gives_rows(spark, name):
    df = plans.QUERIES[name](spark, SF)
    assert df.collect() and len(set(df.columns)) == len(df.columns)


def test_nbbo_has_no_lookahead(spark):
    q = market.quotes(spark, SF)
    cut = q.agg(F.percentile("ts_ns", F.lit(0.5)).cast("long")).first()[0]
    whole = asof.nbbo(q, market.VENUES, market.AGE).where(F.col("ts_ns") <= cut)
    part = asof.nbbo(q.where(F.col("ts_ns") <= cut), market.VENUES, market.AGE)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, part.collect()))


def test_reorder(spark):
    ok = spark.createDataFrame([(1, 0), (1, 1), (3, 2), (10, 3), (8, 4)], "ts long, n long").withColumn("k", F.lit(1))
    assert [r.ts for r in asof.reorder(ok, ["k"], "ts", "n", 5).orderBy("position").collect()] == [1, 1, 3, 8, 10]
    near = spark.createDataFrame([(0, 0), (100, 1), (10, 2)], "ts long, n long").withColumn("k", F.lit(1))
    assert [r.ts for r in asof.reorder(near, ["k"], "ts", "n", 50).orderBy("position").collect()] == [0, 10,
        100]  # nothing above 10 was let go
    rng = np.random.default_rng(1)
    events = [(int(t), i) for i, t in enumerate(np.arange(400) * 3 + rng.integers(-60, 60, 400))]
    got = {r.n: r.late for r in asof.lateness(spark.createDataFrame(events, "ts long, n long").withColumn("k", F.lit(1)), ["k"], "ts", "n",
        70).collect()}
    peak, last, held = -10**9, -10**9, []
    for t, i in events:  # the buffer itself
        assert got[i] == (t < last)
        held.append(t)
        peak = max(peak, t)
        gone = [h for h in held if h <= peak - 70]
        held = [h for h in held if h > peak - 70]
        last = max([last, *gone])
    assert 0 < sum(got.values()) < 100
    late = spark.createDataFrame([(1, 0), (10, 1), (20, 2), (2, 3)], "ts long, n long").withColumn("k", F.lit(1))
    with pytest.raises(Exception, match="lateness"):
        asof.reorder(late, ["k"], "ts", "n", 5).collect()


def rec(kind, seq, bids=(), asks=(), epoch=0, offset=None):
    d = lambda ls: [(Decimal(p), Decimal(s)) for p, s in ls]
    return N(exchange="x", symbol="s", kind=kind, sequence=seq, epoch=epoch, offset=seq if offset is None else offset, bids=d(bids),
        asks=d(asks))


def test_fold():
    events = list(book.fold([rec("snap", 5, [("10", "1")], [("11", "1")]), rec("delta", 6, [("10.5", "2")]), rec("delta", 8, [("10", "0")]),
        rec("delta", 9, [("12", "1")]), rec("delta", 10, [("9", "1")])], True))
    assert [e[1] for e in events] == [0, 0, 1, 0, 0]
    assert [e[2] for e in events] == [None, None, None, "crossed_after_delta", None]
    assert events[3][3][0][0] == Decimal(12) and events[4][3] == [(Decimal(9), Decimal(1))] and events[4][4] == []
    again = list(book.fold([rec("snap", 5, [("10", "1")], [("11", "1")]), rec("delta", 5, [("10.9", "1")]), rec("delta", 4),
        rec("snap", 7, [("3", "1")], [("2", "1")])], False))
    assert [e[2] for e in again] == [None, None, "non_monotonic_seq", "snapshot_crossed"] and again[1][3][0][0] == Decimal(10)


def test_book_trims_and_counts():
    b = book.Book()
    b.snapshot(1, [(Decimal(p), Decimal(1)) for p in (1, 2, 3)], [(Decimal(p), Decimal(1)) for p in (4, 5)])
    assert b.depth() == (3, 2) and b.trim(2) == ([Decimal(1)], []) and b.top(5)[0] == [(Decimal(3), Decimal(1)), (Decimal(2), Decimal(1))]
    assert b.delta(2, [(Decimal(2), Decimal(0))], []) is None and b.depth() == (1, 2)


def simple_fold(rows, contiguous):
    """A book by sorting and dicts alone, one (exchange, symbol, date) at a time."""
    out, sides, seq, epoch = {}, ({}, {}), -1, None
    for r in sorted(rows, key=lambda r: (r.epoch, r.sequence, r.kind != "snap", r.offset)):
        if r.epoch != epoch:
            sides, seq, epoch = ({}, {}), -1, r.epoch
        lv = [[(Decimal(x.px), Decimal(x.sz)) for x in side] for side in (r.bids, r.asks)]
        gap, wrong, shown = 0, None, None
        if r.kind == "snap":
            new = tuple({p: s for p, s in side if s > 0} for side in lv)
            if new[0] and new[1] and max(new[0]) >= min(new[1]):
                wrong = "snapshot_crossed"
            else:
                sides, seq = new, r.sequence
        elif r.sequence != seq:
            gap = max(0, r.sequence - seq - 1) if contiguous and seq >= 0 else 0
            if r.sequence < seq:
                wrong = "non_monotonic_seq"
            else:
                for have, side in zip(sides, lv):
                    for p, s in side:
                        have.pop(p, None)
                        if s:
                            have[p] = s
                if sides[0] and sides[1] and max(sides[0]) >= min(sides[1]):
                    wrong = "crossed_after_delta"
                else:
                    seq = r.sequence
        shown = max(sides[0], default=None), min(sides[1], default=None)
        out[r.kind, r.offset] = (gap, wrong, *shown)
        if wrong:
            sides, seq = ({}, {}), -1
    return out


def test_fold_of_stretches_is_the_fold_of_a_day(spark):
    rng = np.random.default_rng(3)
    rows, offset = [], 0
    for exchange in ("kraken", "other"):
        for epoch in (1, 2):
            seq = 0
            for _ in range(150):
                seq += int(rng.integers(0, 3)) if exchange == "kraken" else 1
                kind = "snap" if rng.random() < 0.1 else "delta"
                lv = lambda lo: [(str(lo + int(rng.integers(0, 12))), str(int(rng.integers(0, 3))))
                    for _ in range(3 if kind == "snap" else 1)]  # noqa: E731, B023
                rows.append((exchange, "s", "d", kind, offset, seq, epoch, offset, lv(90), lv(99), offset * 2))
                offset += 1
    kinds = "exchange string, symbol string, date string, kind string, offset long, sequence long, epoch long, ts_ns long, bids array<struct<px:string,sz:string>>, asks array<struct<px:string,sz:string>>, more long"
    df = spark.createDataFrame(rows, kinds)
    got = {(r.exchange, r.kind, r.offset): r for r in book.fold_books(df, ("more",)).collect()}
    assert len(got) == len(rows) and all(r.more == 2 * r.offset for r in got.values())
    seen = set()
    for exchange in ("kraken", "other"):
        for key, want in simple_fold([r for r in df.collect() if r.exchange == exchange], exchange == "kraken").items():
            r = got[exchange, *key]
            assert (r.seq_gap, r.invariant_kind, r.best_bid, r.best_ask) == want
            seen.add(want[1])
    assert seen == {None, "snapshot_crossed", "crossed_after_delta"} or seen >= {None, "crossed_after_delta"}
    back = spark.createDataFrame([("x", "s", "d", "delta", 5, 1, 0, 0, [], [], 0), ("x", "s", "d", "delta", 4, 2, 0, 0, [], [], 0)], kinds)
    with pytest.raises(Exception, match="out of order"):
        book.fold_books(back).collect()


def test_budget():
    rules = scorecard.budget_rules({"default": {}, "checks": {"latency": {"max_p99_ms": 5}}})
    assert rules[0][4] == 0.0 and rules[1][:4] == ("latency", None, None, 1)
    assert scorecard.load_budget("checks:\n  coverage:\n    min_records: 3\n")[1][-2] == 3.0
    for text in ("- a", "checks:\n  coverage:\n    min_records: true\n", "default:\n  what: 1\n"):
        with pytest.raises(ValueError):
            scorecard.load_budget(text)
    for bad in ({"x": 1}, {"checks": {"nope": {}}}, {"default": {"max_rate": -1}}, {"default": {"max_rate": True}}):
        with pytest.raises(ValueError):
            scorecard.budget_rules(bad)


def test_features(spark):
    t = spark.createDataFrame([(x,) for x in (1, 9, 10, 11)], "ts long")
    assert [r[0] for r in t.select(features.bar("ts", 10)).collect()] == [10, 10, 10, 20]
    dz = spark.createDataFrame([(3.0, 4.0), (-3.0, 4.0), (1.0, 4.0), (None, 4.0)], "r double, s double")
    assert [r[0] for r in dz.select(features.dead_zone(F.col("r"), F.col("s"))).collect()] == [1, -1, 0, None]


def test_folds_and_ridge(spark):
    folds = research.walk_forward([f"d{i:02}" for i in range(14)])
    assert [len(f[0]) for f in folds] == [8, 11] and folds[0][1] == ["d08", "d09", "d10"]
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 2))
    df = spark.createDataFrame([(float(a), float(b), float(2 * a - b + 1)) for a, b in x], "a double, b double, y double")
    beta, icept = research.ridge(df, ["a", "b"], "y", 1e-9)
    assert np.allclose([*beta, icept], [2, -1, 1], atol=1e-6)


def test_information_share_of_a_leader(spark):
    rng = np.random.default_rng(0)
    lead = np.cumsum(rng.standard_normal(4000)) * 1e-4
    follow = np.zeros(4000)
    for i in range(1, 4000):  # closes half of the gap to the leader each step
        follow[i] = follow[i - 1] + 0.5 * (lead[i - 1] - follow[i - 1]) + 1e-5 * rng.standard_normal()
    df = spark.createDataFrame([("d", i, float(a), float(b)) for i, (a, b) in enumerate(zip(lead, follow))],
        "date string, ts_ns long, a double, b double")
    r = research.info_shares(df, lags=3).first()
    assert r.lo > 0.9 and r.gg > 0.9


def test_information_shares_of_all_pairs_and_dates(spark):
    sf, lags, step = "/root/testdata/sf0.01", 10, market.MINUTE
    q = market.quotes(spark, sf).select("symbol", "venue", "ts_ns", "arrival", "bid", "ask").toPandas().sort_values(["ts_ns", "arrival"])
    logs = {}
    for key, x in q.groupby(["symbol", "venue"]):
        ts, mid = x.ts_ns.to_numpy(), (x.bid + x.ask).to_numpy()
        grid = np.arange(-(-ts[0] // step) * step, -(-ts[-1] // step) * step + 1, step)
        at = np.searchsorted(ts, grid, "right") - 1
        logs[key] = {int(t): np.log(float(mid[i])) for t, i in zip(grid, at) if t - ts[i] <= market.AGE}
    want, holes = {}, 0
    for (sym, v), x in logs.items():
        for w in (w for s, w in logs if s == sym and w > v):
            days = {}
            for t in sorted(x.keys() & logs[sym, w].keys()):
                days.setdefault(t // (24 * market.H), []).append(t)
            for day, ts in days.items():
                p, rows, y = {t: np.array([x[t], logs[sym, w][t]]) for t in ts}, [], []
                for t in ts[lags + 1 :]:
                    if not all(t - k * step in p for k in range(lags + 2)):
                        holes += 1
                        continue
                    d = [p[t - k * step] - p[t - (k + 1) * step] for k in range(lags + 1)]
                    y.append(d[0])
                    rows.append(np.r_[1, p[t - step] @ [1, -1], np.concatenate(d[1:])])
                if len(y) < 440:
                    continue
                beta = np.linalg.lstsq(np.array(rows), np.array(y), rcond=None)[0]
                omega = np.cov((np.array(y) - np.array(rows) @ beta).T)
                g = np.array([beta[1][1], -beta[1][0]]) / (beta[1][1] - beta[1][0])
                (aa, ab), (_, bb) = omega
                first = (g[0] * aa + g[1] * ab) ** 2 / aa / (g @ omega @ g)  # the first venue takes what both share
                last = g[0] ** 2 * (aa - ab**2 / bb) / (g @ omega @ g)
                want[sym, v, w, str(np.datetime64(int(day), "D"))] = (len(y), *sorted([first, last]), g[0], ab / np.sqrt(aa * bb))
    got = {(r.symbol, r.venue_a, r.venue_b, r.date): (r.n, r.lo, r.hi, r.gg, r.resid_corr) for r in market.vecm_shares(spark, sf).collect()}
    assert holes and got.keys() == want.keys() and len({k[:3] for k in got}) == 40 and len({k[3] for k in got}) > 25
    assert all(got[k] == pytest.approx(want[k], rel=1e-4, abs=1e-6) for k in want)


def test_wire_and_lake(spark, tmp_path):
    assert [tuple(r[0]) for r in spark.createDataFrame([("trades.coinbase.BTC-USD.x",), ("status.kraken",)],
        "t string").select(wire.topic_parts(F.col("t"), ["trades", "status"])).collect()] == [("trades", "coinbase", "BTC-USD.x"),
        ("status", "kraken", None)]
    assert spark.range(1).select(wire.rfc3339_ns(F.lit("2023-11-14T22:13:20.123456789Z"))).first()[0] == 1_700_000_000_123_456_789
    r = spark.createDataFrame([("trades.x.y", 0, 5, 1_700_000_000_000, None, b'{"t":"trade","exchange":"x","symbol":"y","price":"1E-8"}',
        [("local_recv_ts_ns", b"7")])], wire.RECORD)
    wire.write_corpus(r, str(tmp_path / "c"))
    back = wire.read_corpus(spark, str(tmp_path / "c"))
    assert [tuple(x) for x in back.collect()] == [tuple(x) for x in r.collect()]
    m = wire.decode(back, "trade").select(F.col("m.price").cast("decimal(38,18)").alias("p"),
        wire.header("local_recv_ts_ns").alias("h")).first()
    assert m.p == Decimal("1E-8") and m.h == 7
    rows = spark.createDataFrame([("x", "2023-11-14", 1, "up", None, False, None)], lake.SCHEMAS["silver", "status_events"])
    lake.write(rows, str(tmp_path / "lake"), "silver", "status_events", ["exchange", "date"])
    assert [tuple(x) for x in lake.read(spark, str(tmp_path / "lake"), "silver", "status_events").collect()] == [tuple(x)
        for x in rows.collect()]
    with pytest.raises(ValueError, match="missing"):
        lake.checked(rows.drop("state"), "silver", "status_events")


def test_top_changes_stream_equals_batch(spark, tmp_path):
    q = market.quotes(spark, SF).select("venue", "symbol", "ts_ns", "arrival", F.expr("k div 20").alias("bid_u"),
        F.expr("k div 20 + 1").alias("ask_u"))
    q.write.parquet(str(tmp_path / "in"))
    run = (gateway.top_changes(spark.readStream.schema(q.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("tops").outputMode("append")
           .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    run.awaitTermination()
    want = gateway.changed(q, ["venue", "symbol"], ["ts_ns", "arrival"], ["bid_u", "ask_u"]).select("venue", "symbol", "ts_ns", "bid_u",
        "ask_u")
    assert sorted(map(tuple, spark.table("tops").collect())) == sorted(map(tuple, want.collect()))


def test_counter_resets(spark):
    df = spark.createDataFrame([("a", 0, 5), ("a", 10, 9), ("a", 20, 2)], "k string, ts long, v long")
    assert [r.increase for r in metrics.increase(df, ["k"], "ts", "v", 100).orderBy("ts").collect()] == [0, 4, 6]
