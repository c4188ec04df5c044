"""The live side: books and the consolidated best by brute force, streams against batches, and venue synchronization."""

import json
import zlib
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quaymark.plans import gateway as plans
from quaymark.plans import silver as log_plans
from quaymark.sources import bronze, venues
from quaymark.streaming import gateway

SF = "/root/testdata/sf0.001"


def level(px, sz):
    return [(str(px), str(sz))]


def test_book_holds_deltas_until_their_snapshot():
    b = gateway.LiveBook()
    assert b.on("delta", 1, 5, level(100, 1), [])[0] == "held"
    assert b.on("delta", 2, 1, level(50, 1), [])[0] == "held"
    outcome, top, _ = b.on("snapshot", 1, 4, level(99, 2), level(101, 3))
    assert outcome == "snapshot" and top == ("100", "1", "101", "3") and b.sequence == 5
    assert b.on("delta", 1, 5, level(1, 1), [])[0] == "old"
    assert b.on("delta", 1, 6, [], level(102, 1))[:2] == ("applied", None)  # the top did not change
    assert b.on("snapshot", 1, 6, level(1, 1), level(2, 1))[0] == "stale"
    assert b.on("delta", 1, 7, level("1.01e2", 4), [])[1] is not None  # locked, not crossed: numbers compare as numbers
    assert not b.crossed()
    assert b.on("snapshot", 2, 0, level(40, 1), level(60, 1))[1] == ("50", "1", "60", "1")  # the other epoch's delta was kept


def test_book_heals_when_crossed_and_replays_what_it_applied():
    b = gateway.LiveBook()
    b.on("snapshot", 1, 10, level(99, 1), level(101, 1))
    b.on("delta", 1, 11, level(98, 5), [])
    b.on("delta", 1, 12, level(105, 1), [])
    assert b.crossed()
    b.on("delta", 1, 13, level(97, 2), [])
    outcome, _, _ = b.on("snapshot", 1, 12, level(99, 1), level(101, 1))
    assert outcome == "healed" and not b.crossed() and b.sequence == 13 and Decimal("-97") in b.bids.levels and Decimal("-98") not in b.bids.levels
    b = gateway.LiveBook(held=4)
    b.on("snapshot", 1, 0, level(99, 1), level(101, 1))
    for i in range(1, 8):
        b.on("delta", 1, i, level(99, i), [])
    b.on("delta", 1, 8, level(110, 1), [])
    assert b.on("snapshot", 1, 1, level(99, 1), level(101, 1))[0] == "underrun"  # deltas 2 to 4 are gone


def brute_best(rows, silence):
    """The consolidated best, event by event, with everything worked out anew each time."""
    out, tops, state, heard, clock, last = [], {}, {}, {}, -1, None

    def best():
        live = [v for v in sorted(tops) if not state.get(v, False)]
        if not live:
            return None
        bid, ask = live[0], live[0]
        for v in live[1:]:
            if (Decimal(tops[v][0]), Decimal(tops[v][1])) > (Decimal(tops[bid][0]), Decimal(tops[bid][1])):
                bid = v
            if (-Decimal(tops[v][2]), Decimal(tops[v][3])) > (-Decimal(tops[ask][2]), Decimal(tops[ask][3])):
                ask = v
        return bid, ask, tops[bid][0], tops[bid][1], tops[ask][2], tops[ask][3]

    def turn(pos, venue, down, cause):
        nonlocal last
        if state.get(venue, False) == down:
            return
        state[venue] = down
        if venue in tops:
            b = best()
            last = b[2:] if b else None
            if b:
                out.append((pos, cause, *b))

    for r in rows:
        clock = max(clock, r.ts_ns)
        for v, t in heard.items():
            if clock - t > silence:
                turn(r.position, v, True, "silent")
        if r.state:
            heard[r.exchange] = r.ts_ns
            turn(r.position, r.exchange, r.state != "up", r.state)
        else:
            tops[r.exchange] = (r.bid_px, r.bid_sz, r.ask_px, r.ask_sz)
            b = best()
            if b and b[2:] != last:
                last = b[2:]
                out.append((r.position, "top", *b))
    return out


def test_consolidated_against_brute_force_and_as_a_stream(spark, tmp_path):
    events = plans.events(spark, SF)
    rows = sorted(events.collect(), key=lambda r: r.position)
    got = gateway.consolidated(events, 12 * 3_600_000_000_000).collect()
    for c in {r.canonical for r in rows}:
        mine = [(r.position, r.cause, r.bid_venue, r.ask_venue, r.bid_px, r.bid_sz, r.ask_px, r.ask_sz)
            for r in sorted((x for x in got if x.canonical == c), key=lambda r: r.position)]
        want = brute_best([r for r in rows if r.canonical == c], 12 * 3_600_000_000_000)
        assert sorted(mine) == sorted(want) and want
    assert {r.cause for r in got} >= {"top", "silent", "up"}
    cut = sorted(r.position for r in rows)[len(rows) // 2]
    for name, part in (("0", events.where(F.col("position") <= cut)), ("1", events.where(F.col("position") > cut))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / name))
    stream = spark.readStream.schema(events.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger",
        1).option("latestFirst", "false").parquet(str(tmp_path / "in"))
    q = gateway.consolidated_stream(stream,
        12 * 3_600_000_000_000).writeStream.format("memory").queryName("best").outputMode("append").option("checkpointLocation",
        str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert Counter(map(tuple, spark.table("best").collect())) == Counter(map(tuple, got))


def test_live_books_by_book(spark):
    records = plans.book_records(spark, SF)
    got = {(r.exchange, r.symbol, r.position): r for r in gateway.live_books(records, held=50).collect()}
    rows = records.collect()
    assert len(got) == len(rows)
    books = {}
    for r in sorted(rows, key=lambda r: r.position):
        b = books.setdefault((r.exchange, r.symbol), gateway.LiveBook(50))
        outcome, top, _ = b.on("snapshot" if r.kind == "snap" else "delta", r.epoch, r.sequence, [tuple(x) for x in r.bids],
            [tuple(x) for x in r.asks])
        g = got[r.exchange, r.symbol, r.position]
        assert (g.outcome, g.changed, g.crossed) == (outcome, top is not None, b.crossed())
    assert {r.outcome for r in got.values()} >= {"held", "applied", "snapshot"}


@pytest.mark.parametrize("futures", [False, True])
def test_sync_against_the_rules_written_out(spark, futures):
    events = log_plans._sync_events(spark, SF, 2 if futures else 3)
    got = {(r.connection, r.symbol, r.position): (r.state, r.action) for r in venues.sync(events, futures).collect()}
    groups = {}
    for r in events.collect():
        groups.setdefault((r.connection, r.symbol), []).append(r)
    seen = Counter()
    for key, rows in groups.items():
        live = at = None
        waiting, broken = [], False
        for r in sorted(rows, key=lambda r: r.position):
            def feed(d):
                nonlocal at, live, broken
                first_one = live == "fresh"
                if futures:
                    if first_one:
                        if d.sequence < at:
                            return
                        broken = not d.first <= at <= d.sequence
                    else:
                        broken = d.previous != at
                else:
                    if d.sequence <= at:
                        return
                    broken = d.first > at + 1 if first_one else d.first != at + 1
                if not broken:
                    at, live = d.sequence, "in step"
            if broken:
                pass
            elif r.kind == "snapshot":
                at, live = r.sequence, "fresh"
                for d in waiting:
                    if not broken:
                        feed(d)
            elif live is None:
                waiting.append(r)
            else:
                feed(r)
            state = "stale" if broken else "live" if live else "buffering"
            assert got[*key, r.position][0] == state
            seen[state] += 1
    assert seen["live"] and seen["stale"] and seen["buffering"]


def test_sync_refuses_to_hold_too_much(spark):
    rows = [(1, "s", i, "delta", i, i, i - 1) for i in range(5)]
    got = venues.sync(spark.createDataFrame(rows,
        "connection long, symbol string, position long, kind string, sequence long, first long, previous long"),
        most=3).orderBy("position").collect()
    assert [r.action for r in got] == ["buffer"] * 3 + ["resync", "void"]


def test_numbered_books_check_the_venues_sum(spark):
    def crc(asks, bids):
        return zlib.crc32("".join(x.replace(".", "").lstrip("0") for side in (asks, bids) for l in side for x in l).encode())

    snap = ([("10.5", "1.0"), ("10.4", "2.0"), ("10.3", "0.5")], [("10.6", "0.05"), ("10.7", "3")])
    after = ([("10.55", "1"), ("10.5", "1.0")], [("10.6", "0.05"), ("10.7", "3")])
    rows = [(1, "s", 0, "delta", [], [], 0), (1, "s", 1, "snapshot", *snap, crc(snap[1], snap[0][:2])),
        (1, "s", 2, "delta", [("10.55", "1")], [], crc(after[1], after[0])),
            (1, "s", 3, "delta", [("10.5", "9")], [], 5), (1, "s", 4, "delta", [], [], 5)]
    kinds = "connection long, symbol string, position long, kind string, bids array<struct<px:string,sz:string>>, asks array<struct<px:string,sz:string>>, checksum long"
    got = venues.numbered_books(spark.createDataFrame(rows, kinds), depth=2).orderBy("position").collect()
    assert [(r.sequence, r.ok) for r in got] == [(None, False), (0, True), (1, True), (2, False), (None, False)]
    assert got[1].gone_bids == [] and got[2].gone_bids == ["10.4"]
    assert venues.plain("1E-7") == "0.0000001" and venues.checksum([("1E-7", "2")], []) == zlib.crc32(b"12")


def test_frames_that_are_no_events(spark):
    frames = spark.createDataFrame([(1, '{"result":null}', 5), (2, "not json", 5), (3, '{"channel":"heartbeats","sequence_num":1}', 5)],
        "frame_id long, raw string, recv_ns long")
    for parse in (venues.spot_events, venues.futures_events, venues.channel_events, venues.book_events):
        assert parse(frames).collect() == []
    bad = {"channel": "market_trades", "sequence_num": 1, "timestamp": "2024-01-01T00:00:00Z",
        "events": [{"trades": [{"trade_id": "1", "side": "MAYBE", "time": "2024-01-01T00:00:00Z"}]}]}
    with pytest.raises(Exception, match="unexpected trade side"):
        venues.channel_events(spark.createDataFrame([(1, json.dumps(bad), 5)], frames.schema)).collect()
    poll = spark.createDataFrame([(1, '{"symbol":"S","openInterest":"12.5","time":7}', 9)], frames.schema)
    assert venues.open_interest(poll).select("symbol", "size", "exchange_ts_ns").first() == ("S", "12.5", 7_000_000)


def test_chunks_by_the_rules_written_out(spark):
    records = log_plans.log_records(spark, SF)
    got = {(r.topic, r.partition, r.chunk): (r.start_offset, r.end_offset, r.n_records, r.value_bytes, r.cause)
        for r in bronze.chunks(records, 200_000, 5 * 3_600_000).collect()}
    want, groups = {}, {}
    for r in records.withColumn("date", F.date_format(F.timestamp_millis("timestamp_ms"), "yyyy-MM-dd")).collect():
        groups.setdefault((r.topic, r.partition), []).append(r)
    for key, rows in groups.items():
        rows.sort(key=lambda r: r.offset)
        cuts, held = [], []
        for r in rows:
            if held and r.poll_ms - held[0].poll_ms >= 5 * 3_600_000:
                cuts.append((held, "age"))
                held = []
            if held and held[0].date != r.date:
                cuts.append((held, "date"))
                held = []
            held.append(r)
            if sum(x["size"] for x in held) >= 200_000:
                cuts.append((held, "size"))
                held = []
        if held:
            cuts.append((held, "end"))
        for i, (h, cause) in enumerate(cuts):
            want[*key, i] = (h[0].offset, h[-1].offset, len(h), sum(x["size"] for x in h), cause)
    assert got == want and {c[4] for c in want.values()} >= {"age", "end"}
    small = spark.createDataFrame([("t", 0, i, 0, 60, 0) for i in range(5)],
        "topic string, partition int, offset long, timestamp_ms long, size long, poll_ms long")
    assert [(r.n_records, r.cause) for r in bronze.chunks(small, 100).orderBy("chunk").collect()] == [(2, "size"), (2, "size"), (1, "end")]


def test_topics_as_a_stream(spark, tmp_path):
    rows = [("md.trades.a.S", 0, i, 10 * i, None, b"x", []) for i in range(3)] + [("md.status.a", 0, 9, 5, None, b"y", [])]
    spark.createDataFrame(rows,
        "topic string, partition int, offset long, timestamp_ms long, key binary, value binary, headers array<struct<key:string,value:binary>>").write.parquet(str(tmp_path / "log"))
    q = gateway.subscribe(spark, str(tmp_path / "log"),
        r"^md\.trades\.").writeStream.format("memory").queryName("sub").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r.offset for r in spark.table("sub").collect()) == [0, 1, 2]
    n = bronze.dropped(spark.read.parquet(str(tmp_path / "log")), str(tmp_path / "replay"), 2)
    assert n == 4 and spark.read.parquet(str(tmp_path / "replay")).groupBy("drop").count().orderBy("drop").collect() == [(0, 2), (1, 2)]


def test_instruments_are_checked(spark):
    good = "instruments:\n  A-USD: {base: A, quote: USD, venues: [{exchange: x, symbol: A/USD}]}\n"
    assert bronze.declared(bronze.instruments(spark, good)).collect() == [("x", "A-USD")]
    for bad in ("x: 1", "instruments:\n  A: {base: A, venues: []}", "instruments:\n  A: {base: A, quote: B, venues: [{exchange: x}]}",
                "instruments:\n  A: {base: A, quote: B, venues: [{exchange: x, symbol: s}]}\n  C: {base: A, quote: B, venues: [{exchange: x, symbol: s}]}"):
        with pytest.raises(ValueError):
            bronze.instruments(spark, bad)
