"""Venue frames: normalized events from raw JSON, and the rules that keep a book in step with its venue.

Parsing is ``from_json`` and column expressions. The four synchronization rules are sequential, so they
run as small state machines, one group for each connection and symbol.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .wire import rfc3339_ns

#: The fields of each venue's frames that are read.
_PAIRS = "array<array<string>>"
CHANNELS = ("channel string, timestamp string, sequence_num long, events array<struct<type:string,product_id:string,"
            "updates:array<struct<side:string,event_time:string,price_level:string,new_quantity:string>>,"
            "trades:array<struct<trade_id:string,product_id:string,price:string,size:string,side:string,time:string>>>>")
_LEVEL = "array<struct<price:string,qty:string>>"
BOOKS = (f"channel string, type string, data array<struct<symbol:string,bids:{_LEVEL},asks:{_LEVEL},checksum:bigint,timestamp:string,"
         "trade_id:string,price:string,qty:string,side:string>>")
MAX_BUFFER = 500
DEPTH = 100

EVENT = ["symbol", "kind", "sequence", "exchange_ts_ns", "recv_ns", "bids", "asks", "engine_ts_ns", "trade_id", "price", "size", "side",
    "extra"]


def aggressor(venue: str, flag: Column) -> Column:
    """The taker's side as bid or ask, from what each venue says; other values fail.

    One venue names the maker's side, so that its BUY is a sale; the flag of two others says that the
    buyer is the maker; a forced order is named by its own side."""
    if venue == "coinbase":
        return F.when(flag == "BUY", "ask").when(flag == "SELL",
            "bid").otherwise(F.raise_error(F.concat(F.lit("unexpected trade side "), flag)).cast("string"))
    if venue == "kraken":
        return F.when(flag == "buy", "bid").when(flag == "sell",
            "ask").otherwise(F.raise_error(F.concat(F.lit("unexpected trade side "), flag)).cast("string"))
    if venue == "forced":
        return F.when(flag == "SELL", "ask").otherwise("bid")
    return F.when(flag, "ask").otherwise("bid")


def _pairs(levels: Column) -> Column:
    return F.transform(levels, lambda x: F.struct(x[0].alias("px"), x[1].alias("sz")))


def _named(levels: Column) -> Column:
    return F.transform(levels, lambda x: F.struct(x["price"].alias("px"), x["qty"].alias("sz")))


def _event(df: DataFrame, **cols: Column) -> DataFrame:
    """Event rows; fields that a kind has not are null."""
    kinds = {"symbol": "string", "kind": "string", "sequence": "bigint", "exchange_ts_ns": "bigint", "recv_ns": "bigint",
        "bids": "array<struct<px:string,sz:string>>",
             "asks": "array<struct<px:string,sz:string>>", "engine_ts_ns": "bigint", "trade_id": "string", "price": "string",
             "size": "string", "side": "string", "extra": "map<string,string>"}
    return df.select(*[c for c in df.columns if c == "frame_id"], *[cols.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in EVENT])


def _fields(df: DataFrame, json: Column, names: str) -> DataFrame:
    """Top-level fields of a JSON text as columns: names there may differ in case alone, so that each is read under
    another name. ``names`` lists pairs of field and column."""
    pairs = [x.split("=") for x in names.split()]
    return df.select("*", F.json_tuple(json, *[a for a, _ in pairs]).alias(*[b for _, b in pairs]))


def _book_side(name: str) -> Column:
    return _pairs(F.from_json(name, _PAIRS))


def _ms(name: str) -> Column:
    return F.col(name).cast("long") * 1_000_000


def spot_events(frames: DataFrame) -> DataFrame:
    """``frames(frame_id, raw, recv_ns)`` of the spot venue: depth updates and trades; other frames give no row."""
    m = _fields(frames, F.col("raw"), "e=e s=sym E=at U=first u=last b=bids a=asks t=tid p=px q=qty T=traded m=maker")
    depth = _event(m.where("e = 'depthUpdate'"), symbol=F.col("sym"), kind=F.lit("delta"), sequence=F.col("last"), exchange_ts_ns=_ms("at"),
        recv_ns=F.col("recv_ns"),
                   bids=_book_side("bids"), asks=_book_side("asks"), extra=F.create_map(F.lit("first"), F.col("first")))
    trade = _event(m.where("e = 'trade'"), symbol=F.col("sym"), kind=F.lit("trade"), exchange_ts_ns=_ms("traded"), recv_ns=F.col("recv_ns"),
        trade_id=F.col("tid"), price=F.col("px"),
                   size=F.col("qty"), side=aggressor("spot", F.col("maker").cast("boolean")))
    return depth.unionByName(trade)


def futures_events(frames: DataFrame) -> DataFrame:
    """Combined-stream frames of the futures venue: depth, trades, forced orders and mark prices."""
    outer = _fields(frames, F.col("raw"), "stream=stream data=data").where("stream is not null")
    m = _fields(outer, F.col("data"),
        "e=e s=sym E=at U=first u=last pu=before b=bids a=a p=px q=qty T=traded m=maker i=idx P=settle r=rate o=o")
    recv = F.col("recv_ns")
    depth = _event(m.where("e = 'depthUpdate'"), symbol=F.col("sym"), kind=F.lit("delta"), sequence=F.col("last"), exchange_ts_ns=_ms("at"),
        recv_ns=recv, bids=_book_side("bids"), asks=_book_side("a"),
                   extra=F.create_map(F.lit("first"), F.col("first"), F.lit("previous"), F.col("before")))
    trade = _event(m.where("e = 'aggTrade'"), symbol=F.col("sym"), kind=F.lit("trade"), exchange_ts_ns=_ms("traded"), recv_ns=recv,
        trade_id=F.col("a"), price=F.col("px"), size=F.col("qty"),
                   side=aggressor("futures", F.col("maker").cast("boolean")))
    orders = _fields(m.where("e = 'forceOrder'").select("frame_id", "recv_ns", "o"), F.col("o"),
        "s=sym S=way p=px ap=avg q=qty z=filled X=status T=traded")
    forced = _event(orders, symbol=F.col("sym"), kind=F.lit("liquidation"), exchange_ts_ns=_ms("traded"), recv_ns=recv, price=F.col("px"),
        size=F.col("qty"), side=aggressor("forced", F.col("way")),
                    extra=F.create_map(F.lit("avg_price"), F.col("avg"), F.lit("filled_size"), F.col("filled"), F.lit("status"),
                    F.col("status")))
    mark = _event(m.where("e = 'markPriceUpdate'"), symbol=F.col("sym"), kind=F.lit("mark_price"), exchange_ts_ns=_ms("at"), recv_ns=recv,
        price=F.col("px"),
                  extra=F.create_map(F.lit("index_price"), F.col("idx"), F.lit("est_settle_price"), F.col("settle"), F.lit("funding_rate"),
                  F.col("rate"),
                                     F.lit("next_funding_ts_ns"), _ms("traded").cast("string")))
    return depth.unionByName(trade).unionByName(forced).unionByName(mark)


def open_interest(polls: DataFrame) -> DataFrame:
    """``polls(frame_id, raw, recv_ns)``: answers of the open-interest endpoint."""
    m = polls.withColumn("m", F.from_json("raw", "symbol string, openInterest string, time long"))
    return _event(m, symbol=F.col("m.symbol"), kind=F.lit("open_interest"), exchange_ts_ns=F.col("m.time") * 1_000_000,
        recv_ns=F.col("recv_ns"), size=F.col("m.openInterest"))


def engine_time(updates: Column) -> Column:
    """The latest engine time among a book event's updates, 0 if none has one: parsed first, as trimmed
    fractions do not sort as text."""
    times = F.transform(F.array_distinct(F.transform(updates, lambda u: u["event_time"])),
        lambda t: F.when(F.length(t) > 0, rfc3339_ns(t)).otherwise(F.lit(0)))
    return F.coalesce(F.array_max(times), F.lit(0))


def channel_events(frames: DataFrame) -> DataFrame:
    """Frames of the venue whose channels share one sequence per connection: level-2 books and trades."""
    m = frames.withColumn("m", F.from_json("raw", CHANNELS))
    one = m.select("frame_id", "recv_ns", "m", F.explode("m.events").alias("ev"))

    def side(*names: str) -> Column:
        odd = F.filter("ev.updates", lambda u: ~u["side"].isin("bid", "offer", "ask"))
        own = F.transform(F.filter("ev.updates", lambda u: u["side"].isin(*names)),
            lambda u: F.struct(u["price_level"].alias("px"), u["new_quantity"].alias("sz")))
        return F.when(F.size(odd) > 0,
            F.raise_error(F.concat(F.lit("unexpected level side "),
            odd[0]["side"])).cast("array<struct<px:string,sz:string>>")).otherwise(own)

    book = _event(one.where("m.channel = 'l2_data'"), symbol=F.col("ev.product_id"),
        kind=F.when(F.col("ev.type") == "snapshot", "snapshot").otherwise("delta"), sequence=F.col("m.sequence_num"),
                  exchange_ts_ns=rfc3339_ns(F.col("m.timestamp")), recv_ns=F.col("recv_ns"), bids=side("bid"), asks=side("offer", "ask"),
                  engine_ts_ns=engine_time(F.col("ev.updates")))
    t = one.where("m.channel = 'market_trades'").select("frame_id", "recv_ns", "m", F.explode("ev.trades").alias("t"))
    trade = _event(t, symbol=F.col("t.product_id"), kind=F.lit("trade"), sequence=F.col("m.sequence_num"),
        exchange_ts_ns=rfc3339_ns(F.col("t.time")), recv_ns=F.col("recv_ns"),
                   trade_id=F.col("t.trade_id"), price=F.col("t.price"), size=F.col("t.size"), side=aggressor("coinbase", F.col("t.side")))
    return book.unionByName(trade)


def book_events(frames: DataFrame) -> DataFrame:
    """Frames of the venue whose books carry a checksum: books and trades, numbers kept as they are written."""
    m = frames.withColumn("m", F.from_json("raw", BOOKS))
    d = m.select("frame_id", "recv_ns", "m", F.explode("m.data").alias("d"))
    book = _event(d.where("m.channel = 'book'"), symbol=F.col("d.symbol"),
        kind=F.when(F.col("m.type") == "snapshot", "snapshot").otherwise("delta"), exchange_ts_ns=rfc3339_ns(F.col("d.timestamp")),
                  recv_ns=F.col("recv_ns"), bids=_named(F.col("d.bids")), asks=_named(F.col("d.asks")),
                  extra=F.create_map(F.lit("checksum"), F.col("d.checksum").cast("string")))
    trade = _event(d.where("m.channel = 'trade'"), symbol=F.col("d.symbol"), kind=F.lit("trade"),
        exchange_ts_ns=rfc3339_ns(F.col("d.timestamp")), recv_ns=F.col("recv_ns"),
                   trade_id=F.col("d.trade_id"), price=F.col("d.price"), size=F.col("d.qty"), side=aggressor("kraken", F.col("d.side")))
    return book.unionByName(trade)


def sequence_check(frames: DataFrame, by: list[str], order: str, seq: str) -> DataFrame:
    """``verdict`` of a connection-wide sequence: ok, repeat (a number already passed: dropped) or gap (resync).

    The number expected is one above the highest of those that came in step; a gap ends the connection, so
    that frames after it are ``void`` until the next one of ``by`` begins."""
    w = Window.partitionBy(*by).orderBy(order)
    high = F.max(seq).over(w.rowsBetween(Window.unboundedPreceding, -1))
    jump = frames.withColumn("_high", high).withColumn("_gap", F.coalesce(F.col(seq) > F.col("_high") + 1, F.lit(False)))
    ended = F.coalesce(F.max(F.col("_gap").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) == 1
    verdict = F.when(ended, "void").when(F.col("_gap"), "gap").when(F.col(seq) <= F.col("_high"), "repeat").otherwise("ok")
    return jump.withColumn("verdict", verdict).drop("_high", "_gap")


def epochs(connections: DataFrame, by: list[str], order: str, now_ns: str) -> DataFrame:
    """``epoch`` of each connection: its time, and at least one above the last, whatever the clock does.

    ``max(previous + 1, now)`` unrolls to a running maximum of time less place."""
    w = Window.partitionBy(*by).orderBy(order)
    n = F.row_number().over(w).cast("long")
    lead = connections.withColumn("_n", n)
    return lead.withColumn("epoch", F.max(F.col(now_ns) - F.col("_n")).over(w.rowsBetween(Window.unboundedPreceding, 0))
        + F.col("_n")).drop("_n")


def straddles(first: int, last: int, previous: int | None, at: int, fresh: bool, futures: bool) -> str:
    """What the book at update ``at`` does with a delta of updates ``first .. last``: apply, drop, hold or resync.

    Spot: the first delta after the snapshot must reach back to the next update, later ones must begin
    with it. Futures: the first must hold the snapshot's update (``hold``: it ends there and is in step),
    later ones must name the last delta's end as their previous."""
    if futures:
        if fresh:
            if last < at:
                return "drop"
            if not first <= at <= last:
                return "resync"
            return "hold" if last == at else "apply"
        return "apply" if previous == at else "resync"
    if last <= at:
        return "drop"
    return "apply" if (first <= at + 1 if fresh else first == at + 1) else "resync"


SYNC = "connection long, symbol string, position long, kind string, sequence long, state string, action string, replayed long"


def sync(events: DataFrame, futures: bool = False, most: int = MAX_BUFFER) -> DataFrame:
    """The life of each book, a row per event: ``state`` after it and what became of it.

    ``events(connection, symbol, position, kind, sequence, first, previous)``, kinds ``snapshot`` and
    ``delta``. Deltas before the snapshot are held, up to ``most``, and replayed on it; a book that falls
    out of step is stale, and its later events are void until the next connection. The states are
    buffering, live and stale; ``replayed`` counts the held deltas that a snapshot let through."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        state, at, fresh, held, rows = "buffering", -1, False, [], []
        for e in pdf.sort_values("position").itertuples(index=False):
            action, replayed = "void", 0
            if state == "stale":
                pass
            elif e.kind == "snapshot":
                state, at, fresh, action = "live", int(e.sequence), True, "snapshot"
                for h in held:
                    did = straddles(h[0], h[1], h[2], at, fresh, futures)
                    if did == "resync":
                        state, action = "stale", "resync"
                        break
                    if did in ("apply", "hold"):
                        fresh, replayed = False, replayed + (did == "apply")
                        at = h[1]
                held = []
            else:
                delta = (int(e.first), int(e.sequence), None if pd.isna(e.previous) else int(e.previous))
                if state == "buffering":
                    action = "resync" if len(held) >= most else "buffer"
                    if action == "resync":
                        state = "stale"
                    held.append(delta)
                else:
                    action = straddles(*delta, at, fresh, futures)
                    if action == "resync":
                        state = "stale"
                    elif action != "drop":
                        at, fresh = delta[1], False
            rows.append((e.connection, e.symbol, e.position, e.kind, e.sequence, state, action, replayed))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SYNC.split(", ")])

    cols = ["connection", "symbol", "position", "kind", "sequence", "first", "previous"]
    return events.select(*cols).groupBy("connection", "symbol").applyInPandas(run, SYNC)


def recv_clock(frames: DataFrame, by: list[str], order: str, recv: str) -> DataFrame:
    """Backward steps of the receive clock between consecutive frames, and the worst in milliseconds."""
    w = Window.partitionBy(*by).orderBy(order)
    step = F.lag(recv).over(w) - F.col(recv)
    back = frames.withColumn("_s", step)
    return back.groupBy(*by).agg(F.count_if(F.col("_s") > 0).alias("backward_steps"),
        (F.coalesce(F.max(F.when(F.col("_s") > 0, F.col("_s"))), F.lit(0)) / 1e6).alias("worst_step_ms"))


def silences(frames: DataFrame, by: list[str], recv: str, most_ns: int) -> DataFrame:
    """Stretches longer than ``most_ns`` without a frame: ``(*by, from_ns, to_ns, silent_ns)``, what a watchdog reconnects on."""
    w = Window.partitionBy(*by).orderBy(recv)
    gap = frames.withColumn("from_ns", F.lag(recv).over(w)).withColumn("silent_ns", F.col(recv) - F.col("from_ns"))
    return gap.where(F.col("silent_ns") > most_ns).select(*by, "from_ns", F.col(recv).alias("to_ns"), "silent_ns")


CHECKED = "connection long, symbol string, position long, sequence long, checksum long, ok boolean, gone_bids array<string>, gone_asks array<string>"


def plain(number: str) -> str:
    """A decimal string without exponent, as the venue writes it."""
    from decimal import Decimal

    return format(Decimal(number), "f")


def checksum(asks: list[tuple[str, str]], bids: list[tuple[str, str]]) -> int:
    """CRC32 over ten asks, then ten bids, best first: price and size without dot and leading zeros."""
    import zlib

    return zlib.crc32("".join(plain(x).replace(".", "").lstrip("0") for side in (asks[:10], bids[:10]) for level in side
        for x in level).encode())


def numbered_books(events: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Books without sequence numbers: numbers of our own from the snapshot on (0, 1, ...), levels beyond ``depth``
    dropped and named, and the venue's checksum verified.

    ``events(connection, symbol, position, kind, bids, asks, checksum)``. The venue drops deep levels without
    saying so; ``gone_bids`` and ``gone_asks`` are the prices to relay as deletes. After a mismatch a book is
    stale: its later events have a null sequence."""
    from quaymark.operators.book import Book, _levels

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        book, rows = None, []
        for e in pdf.sort_values("position").itertuples(index=False):
            ok, gone, seq, got = False, ([], []), None, None
            if e.kind == "snapshot" or book is not None:
                bids, asks = _levels(e.bids), _levels(e.asks)
                if e.kind == "snapshot":
                    book, seq = Book(), 0
                    wrong = book.snapshot(0, bids, asks)
                else:
                    seq = book.sequence + 1
                    wrong = book.delta(seq, bids, asks)
                gone = book.trim(depth)
                b, a = book.top(10)
                got = checksum([(str(p), str(s)) for p, s in a], [(str(p), str(s)) for p, s in b])
                ok = wrong is None and got == int(e.checksum)
                if e.kind == "snapshot":
                    gone = ([], [])
                if not ok:
                    book = None
            rows.append((e.connection, e.symbol, e.position, seq, got, ok, [plain(str(p)) for p in gone[0]],
                [plain(str(p)) for p in gone[1]]))
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in CHECKED.split(", ")])
        return out.astype({"sequence": "Int64", "checksum": "Int64"})

    cols = ["connection", "symbol", "position", "kind", "bids", "asks", "checksum"]
    return events.select(*cols).groupBy("connection", "symbol").applyInPandas(run, CHECKED)


def resnapshots(levels: DataFrame, by: list[str], at_ns: int) -> DataFrame:
    """Whole books as snapshots of our own: ``levels(*by, sequence, epoch, side, px, sz)`` to one row per book, both
    sides best first, without an exchange time."""
    number = F.col("px").cast("decimal(38,18)")
    side = lambda name, key: F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == name,
        F.struct(key.alias("k"), F.col("px").alias("px"), F.col("sz").alias("sz"))))),
                                         lambda x: F.struct(x["px"].alias("px"), x["sz"].alias("sz")))
    return levels.groupBy(*by, "sequence", "epoch").agg(side("bid", -number).alias("bids"), side("ask", number).alias("asks")).select(
        *by, "sequence", "epoch", "bids", "asks", F.lit(0).cast("long").alias("exchange_ts_ns"),
        F.lit(at_ns).cast("long").alias("local_ts_ns"))
