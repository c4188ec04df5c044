"""Streams: the bronze sink, books and their tops, and the best over venues, in the order of a log.

Book and consolidated state follow the log's own clock, never a wall clock, so that the same log gives the
same rows, as a batch or as a stream. The state machines are plain Python, one key's events at a time;
what needs no state machine is a window.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import deque
from collections.abc import Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TOP = "venue string, symbol string, ts_ns long, bid_u long, ask_u long"
HELD = 10_000


def stream_clock(rows: DataFrame, ts: str, order: str, by: list[str]) -> DataFrame:
    """``clock``: the highest event time so far; outputs never read a wall clock."""
    return rows.withColumn("clock", F.max(ts).over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))


def changed(rows: DataFrame, by: list[str], order: list[str], cols: list[str]) -> DataFrame:
    """Rows whose ``cols`` differ from those of the row before."""
    prev = F.lag(F.struct(*cols)).over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("_p", prev).where(F.col("_p").isNull() | ~F.col("_p").eqNullSafe(F.struct(*cols))).drop("_p")


def compact(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """The latest row of each key, as a compacted topic holds it; also what a client gets on connecting."""
    return rows.groupBy(*by).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in by]), order).alias("r")).select(*by, "r.*")


def subscribe(spark: SparkSession, path: str, pattern: str, kafka: dict[str, str] | None = None) -> DataFrame:
    """Log records of the topics that ``pattern`` matches, as a stream from the live edge.

    From a broker where its address is given and the connector is there; else from a folder of
    records in the same shape, as :func:`bronze_sink` writes them."""
    if kafka:
        raw = spark.readStream.format("kafka").options(**kafka).option("subscribePattern", pattern).option("includeHeaders", "true").load()
        return raw.select("topic", "partition", "offset", F.unix_millis("timestamp").alias("timestamp_ms"), "key", "value", "headers")
    from quaymark.sources.wire import RECORD

    return spark.readStream.schema(RECORD).parquet(path).where(F.col("topic").rlike(pattern))


def bronze_sink(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Log records to Parquet by topic and date: exactly once, by the checkpoint."""
    out = records.withColumn("date", F.date_format(F.timestamp_millis("timestamp_ms"), "yyyy-MM-dd"))
    return out.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("topic",
        "date").trigger(availableNow=True).start()


def top_changes(quotes: DataFrame) -> DataFrame:
    """On a stream ``(venue, symbol, ts_ns, arrival, bid_u, ask_u)``: tops that differ from the last one."""

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get if state.exists else None
        rows = []
        for r in pd.concat(list(pdfs)).sort_values(["ts_ns", "arrival"]).itertuples():
            top = (int(r.bid_u), int(r.ask_u))
            if top != last:
                rows.append((*key, int(r.ts_ns), *top))
                last = top
        if last is not None:
            state.update(last)
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in TOP.split(", ")])

    return quotes.groupBy("venue", "symbol").applyInPandasWithState(run, TOP, "bid_u long, ask_u long", "append",
        GroupStateTimeout.NoTimeout)


class Side:
    """One side of a book by price, with the best price at hand."""

    def __init__(self, sign: int) -> None:
        self.sign, self.keys, self.levels = sign, [], {}

    def set(self, px: str, sz: str) -> None:
        key = self.sign * Decimal(px)
        here = key in self.levels
        if Decimal(sz) == 0:
            if here:
                del self.levels[key]
                del self.keys[bisect_left(self.keys, key)]
        else:
            if not here:
                insort(self.keys, key)
            self.levels[key] = (px, sz)

    def best(self) -> tuple[str, str] | None:
        return self.levels[self.keys[0]] if self.keys else None

    def best_price(self) -> Decimal:
        return self.sign * self.keys[0]


class LiveBook:
    """A venue's book as the gateway keeps it, from snapshots and deltas that arrive on two topics in any order.

    Deltas that come before their epoch's snapshot are held, the newest ``held`` of them. A snapshot at or
    below the book's place is skipped unless the book is crossed: then it replaces the book, and the
    deltas applied since are replayed on it. What was applied is remembered up to ``held`` deltas, the older
    half being let go at that; a healing that needs those is counted as an underrun.
    """

    def __init__(self, held: int = HELD) -> None:
        self.held = held
        self.bids, self.asks, self.sequence, self.epoch = Side(-1), Side(1), -1, 0
        self.waiting: deque = deque(maxlen=held)
        self.applied: list = []
        self.shed: tuple[int, int] | None = None
        self.last: tuple | None = None

    def crossed(self) -> bool:
        return bool(self.bids.keys and self.asks.keys) and self.asks.best_price() < self.bids.best_price()

    def _apply(self, d: tuple) -> bool:
        if d[1] <= self.sequence:
            return False
        for side, levels in ((self.bids, d[2]), (self.asks, d[3])):
            for px, sz in levels:
                side.set(px, sz)
        self.sequence = d[1]
        return True

    def _remember(self, d: tuple) -> None:
        if len(self.applied) >= self.held:
            cut = self.held // 2
            self.shed = self.applied[cut - 1][:2]
            del self.applied[:cut]
        self.applied.append(d)

    def on(self, kind: str, epoch: int, sequence: int, bids: list, asks: list, tag: object = None) -> tuple[str, tuple | None, object]:
        """``(what became of it, the top if it changed, the tag of the last event in it)``."""
        if kind == "delta":
            d = (epoch, sequence, bids, asks, tag)
            if self.sequence < 0 or epoch != self.epoch:
                self.waiting.append(d)
                return "held", None, tag
            if not self._apply(d):
                return "old", None, tag
            self._remember(d)
            return "applied", self._top(), tag
        again = epoch == self.epoch and sequence <= self.sequence
        if again and not self.crossed():
            return "stale", None, tag
        self.bids, self.asks, self.sequence, self.epoch = Side(-1), Side(1), sequence, epoch
        for side, levels in ((self.bids, bids), (self.asks, asks)):
            for px, sz in levels:
                side.set(px, sz)
        same = [d for d in self.applied if d[0] == epoch]
        for d in same:
            if self._apply(d):
                tag = d[4]
        self.applied = [d for d in same if d[1] > sequence]
        lost = self.shed is not None and self.shed[0] == epoch and self.shed[1] > sequence
        if not lost:
            self.shed = None
        ready = [d for d in self.waiting if d[0] == epoch]
        self.waiting = deque((d for d in self.waiting if d[0] != epoch), maxlen=self.held)
        for d in ready:
            if self._apply(d):
                self._remember(d)
                tag = d[4]
        return ("underrun" if lost else "healed") if again else "snapshot", self._top(), tag

    def _top(self) -> tuple | None:
        bid, ask = self.bids.best(), self.asks.best()
        if bid is None or ask is None or (top := (*bid, *ask)) == self.last:
            return None
        self.last = top
        return top


BBO = "exchange string, symbol string, position long, outcome string, crossed boolean, changed boolean, bid_px string, bid_sz string, ask_px string, ask_sz string, ts_ns long"


def live_books(records: DataFrame, held: int = HELD) -> DataFrame:
    """Every book event in the order of the log with what became of it and, where it changed, the new top (``BBO``).

    ``records(exchange, symbol, position, kind, epoch, sequence, bids, asks, ts_ns)``, kinds ``snap`` and ``delta``,
    levels as ``array<struct<px:string,sz:string>>``; ``ts_ns`` of a top is that of the last event in it."""
    names = [c.split()[0] for c in BBO.split(", ")]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        book, rows = LiveBook(held), []
        for r in pdf.sort_values("position").itertuples(index=False):
            sides = ([(x["px"], x["sz"]) for x in (levels if levels is not None else ())] for levels in (r.bids, r.asks))
            outcome, top, ts = book.on("snapshot" if r.kind == "snap" else "delta", int(r.epoch), int(r.sequence), *sides, r.ts_ns)
            rows.append((r.exchange, r.symbol, r.position, outcome, book.crossed(), top is not None, *(top or (None,) * 4), ts))
        return pd.DataFrame(rows, columns=names)

    return records.select("exchange", "symbol", "position", "kind", "epoch", "sequence", "bids", "asks", "ts_ns").groupBy("exchange",
        "symbol").applyInPandas(run, BBO)


def decimal(text: Column) -> Column:
    """A decimal string, with or without exponent, as a number to compare by; its text stays what is shown."""
    return text.cast("decimal(38,18)")


def fresh_cross(crossed: Column, bid_age_ms: Column, ask_age_ms: Column, most_ms: float = 1000) -> Column:
    return crossed & (bid_age_ms <= most_ms) & (ask_age_ms <= most_ms)


def cross_bps(spread: Column, mid: Column) -> Column:
    """How deep a cross is, in basis points; negative where there is none, 0 without a price."""
    return F.when(mid > 0, -spread / mid * 1e4).otherwise(0.0)


def leg_age_ms(now_ns: Column, leg_ns: Column) -> Column:
    return F.greatest(F.lit(0.0), (now_ns - leg_ns) / 1e6)


def material(crossed: Column, bid_age_ms: Column, ask_age_ms: Column, spread: Column, mid: Column, most_ms: float = 1000,
    least_bps: float = 10) -> Column:
    """A cross worth an alert: both legs fresh and at least ``least_bps`` deep."""
    return fresh_cross(crossed, bid_age_ms, ask_age_ms, most_ms) & (cross_bps(spread, mid) >= least_bps)


def best_legs(events: DataFrame, venues: list[str]) -> DataFrame:
    """The best over venues as it is emitted: after every change of the best, and whenever a venue goes or comes back.

    ``events(canonical, position, ts_ns, exchange, bid_px, bid_sz, ask_px, ask_sz, down)``: tops, and status
    changes (``down`` not null, prices null). ``canonical, position, ts_ns, bid_venue, ask_venue,`` the four
    numbers, ``n_venues, clock``. A better price wins, then the larger size, then the first name. When no venue
    is left nothing is emitted, and the next best is, whatever it is. A venue without a top in a
    canonical does not touch it; a status that changes nothing emits nothing.
    """
    w = Window.partitionBy("canonical").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("canonical").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    quote = F.col("down").isNull()
    top = F.struct("bid_px", "bid_sz", "ask_px", "ask_sz", F.col("ts_ns").alias("at"))
    names = F.array(*[F.lit(v) for v in venues])
    legs = F.array(*[F.last(F.when(quote & (F.col("exchange") == v), top), ignorenulls=True).over(w) for v in venues])
    downs = F.array(*[F.coalesce(F.last(F.when(F.col("exchange") == v, F.col("down")), ignorenulls=True).over(w), F.lit(False))
        for v in venues])
    was = F.array(*[F.coalesce(F.last(F.when(F.col("exchange") == v, F.col("down")), ignorenulls=True).over(before), F.lit(False))
        for v in venues])
    out = events.withColumn("clock", F.max("ts_ns").over(w)).withColumn("_legs", legs).withColumn("_downs", downs).withColumn("_was", was)
    at = F.array_position(names, F.col("exchange")).cast("int") - 1
    zipped = F.transform(names, lambda v, i: F.struct(v.alias("v"), F.get("_legs", i).alias("leg"), F.get("_downs", i).alias("down")))
    live = F.filter(zipped, lambda x: x["leg"].isNotNull() & ~x["down"])
    out = out.withColumn("_live", live)
    # sorted so that the first is the winner: the sign of what is to be large is turned
    bids = F.array_sort(F.transform("_live", lambda x: F.struct((-decimal(x["leg"]["bid_px"])).alias("p"),
        (-decimal(x["leg"]["bid_sz"])).alias("s"), x["v"].alias("v"), x["leg"].alias("leg"))))
    asks = F.array_sort(F.transform("_live", lambda x: F.struct(decimal(x["leg"]["ask_px"]).alias("p"),
        (-decimal(x["leg"]["ask_sz"])).alias("s"), x["v"].alias("v"), x["leg"].alias("leg"))))
    some = F.size("_live") > 0
    out = out.withColumn("_bid", F.when(some, F.get(bids, F.lit(0)))).withColumn("_ask", F.when(some, F.get(asks, F.lit(0))))
    best = F.struct(F.col("_bid.leg.bid_px").alias("bid_px"), F.col("_bid.leg.bid_sz").alias("bid_sz"),
        F.col("_ask.leg.ask_px").alias("ask_px"), F.col("_ask.leg.ask_sz").alias("ask_sz"))
    turned = ~quote & (F.get("_was", at) != F.col("down")) & F.get("_legs", at).isNotNull()
    # what the row leaves as the last emitted: a top's best if there is one, a status change's in any case
    sets = F.when(turned | (quote & some), F.struct(F.when(some, best).alias("best")))
    out = out.withColumn("_best", best).withColumn("_some", some).withColumn("_turned", turned).withColumn("_sets", sets)
    out = out.withColumn("_old", F.last("_sets", ignorenulls=True).over(before))
    fresh = F.col("_old").isNull() | ~F.col("_old.best").eqNullSafe(F.col("_best"))
    emitted = out.where(F.col("_some") & (F.col("_turned") | (quote & fresh)))
    return emitted.select(
        "canonical", "position", "ts_ns", F.col("_bid.v").alias("bid_venue"), F.col("_ask.v").alias("ask_venue"), "_best.*",
        F.size("_live").cast("long").alias("n_venues"),
        "clock", F.col("_bid.leg.at").alias("bid_at"), F.col("_ask.leg.at").alias("ask_at"))


NBBO = ("canonical string, position long, clock long, cause string, bid_venue string, ask_venue string, bid_px string, bid_sz string, ask_px string, ask_sz string, "
        "crossed boolean, spread double, mid double, n_venues long, bid_age_ms double, ask_age_ms double")
NAMES = [c.split()[0] for c in NBBO.split(", ")]


class Consolidated:
    """One canonical instrument's venues: their tops, who is down or silent, and the best last emitted.

    Its clock is the highest time in its own events and the status of all venues. A venue whose last status is
    more than ``silence_ns`` behind the clock counts as down until its next one; one that never
    sent a status is up.
    """

    def __init__(self, silence_ns: int) -> None:
        self.silence = silence_ns
        self.clock = -1
        self.tops: dict[str, tuple] = {}
        self.down: set[str] = set()
        self.heard: dict[str, int] = {}
        self.last: tuple | None = None

    def on(self, position: int, ts: int, exchange: str, top: tuple | None, state: str | None) -> list[tuple]:
        """The rows that one event emits: for venues that fell silent by its time, then for itself."""
        self.clock = max(self.clock, ts)
        out = []
        for venue, at in self.heard.items():
            if self.clock - at > self.silence:
                out += self._turn(position, venue, True, "silent")
        if state is not None:
            self.heard[exchange] = ts
            out += self._turn(position, exchange, state != "up", state)
        else:
            self.tops[exchange] = (*top, ts)
            best = self._best()
            if best is not None and best[2] != self.last:
                self.last = best[2]
                out.append(self._row(position, "top", best))
        return out

    def _turn(self, position: int, venue: str, down: bool, cause: str) -> list[tuple]:
        if down == (venue in self.down):
            return []
        (self.down.add if down else self.down.discard)(venue)
        if venue not in self.tops:
            return []
        best = self._best()
        self.last = None if best is None else best[2]
        return [] if best is None else [self._row(position, cause, best)]

    def _best(self) -> tuple | None:
        live = sorted(v for v in self.tops if v not in self.down)
        if not live:
            return None
        bid = max(live, key=lambda v: (Decimal(self.tops[v][0]), Decimal(self.tops[v][1]), [-ord(c) for c in v]))
        ask = min(live, key=lambda v: (Decimal(self.tops[v][2]), -Decimal(self.tops[v][3]), v))
        return bid, ask, (*self.tops[bid][:2], *self.tops[ask][2:4]), len(live)

    def _row(self, position: int, cause: str, best: tuple) -> tuple:
        bid, ask, numbers, n = best
        b, a = float(numbers[0]), float(numbers[2])
        ages = [max(0.0, (self.clock - self.tops[v][4]) / 1e6) for v in (bid, ask)]
        return ("", position, self.clock, cause, bid, ask, *numbers, Decimal(numbers[2]) < Decimal(numbers[0]), a - b, (a + b) / 2, n,
            *ages)


def _fed(machine: Consolidated, pdf: pd.DataFrame) -> list[tuple]:
    rows = []
    for r in pdf.sort_values("position").itertuples(index=False):
        state = r.state if isinstance(r.state, str) else None
        top = None if state else (r.bid_px, r.bid_sz, r.ask_px, r.ask_sz)
        rows += [(r.canonical, *x[1:]) for x in machine.on(int(r.position), int(r.ts_ns), r.exchange, top, state)]
    return rows


def consolidated(events: DataFrame, silence_ns: int) -> DataFrame:
    """The emitted best of each canonical (``NBBO``) from a whole log: ``events(canonical, position, ts_ns, exchange,
    bid_px, bid_sz, ask_px, ask_sz, state)``, tops and, for each canonical, the status of all venues."""
    run = lambda pdf: pd.DataFrame(_fed(Consolidated(silence_ns), pdf), columns=NAMES)
    return events.groupBy("canonical").applyInPandas(run, NBBO)


def consolidated_stream(events: DataFrame, silence_ns: int) -> DataFrame:
    """The same of a stream: the state of each canonical is kept from batch to batch."""

    def run(key: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        import pickle

        machine = Consolidated(silence_ns)
        if state.exists:
            vars(machine).update(pickle.loads(state.get[0]))
        rows = _fed(machine, pd.concat(list(pdfs)))
        state.update((pickle.dumps(vars(machine)),))
        yield pd.DataFrame(rows, columns=NAMES)

    return events.groupBy("canonical").applyInPandasWithState(run, NBBO, "machine binary", "append", GroupStateTimeout.NoTimeout)


def route(messages: DataFrame, tag: str = "t") -> DataFrame:
    """``goes_to``: what the gateway does with a message: books feed the books, trades pass through, status feeds the venues."""
    where = F.when(F.col(tag).isin("snap", "delta"), "book").when(F.col(tag) == "trade", "broadcast").when(F.col(tag) == "status",
        "status").otherwise("ignored")
    return messages.withColumn("goes_to", where)


def lag(marks: DataFrame) -> DataFrame:
    """``lag`` of each partition: records below the high-water mark that are not consumed yet; ``marks(topic, partition, high, consumed)``,
    ``consumed`` the last offset read, null for none."""
    return marks.withColumn("lag", F.greatest(F.lit(0), F.col("high") - 1 - F.coalesce("consumed", F.lit(-1))).cast("long"))


def warm_start(partitions: DataFrame) -> DataFrame:
    """Where each partition is read from on a restart, and how far until output is let out.

    ``partitions(topic, partition, high, at_cutoff)``: ``at_cutoff`` is the first offset within the
    lookback, null or negative for none. Of snapshots the newest is enough, if it is within the lookback; deltas
    and status are read from the lookback on; all others, and what has nothing that recent, from the live
    edge. Books below the live edge are drained up to it. Topics of no known kind have no row."""
    kind = F.when(F.col("topic").rlike("^md\\.status\\."), "status").when(F.col("topic").rlike("^md\\.trades\\."), "trades")
    kind = kind.when(F.col("topic").rlike("^md\\.book\\..*\\.snapshots$"),
        "snapshots").when(F.col("topic").rlike("^md\\.book\\..*\\.deltas$"), "deltas")
    recent = F.coalesce((F.col("at_cutoff") >= 0) & (F.col("at_cutoff") < F.col("high")), F.lit(False)) & (F.col("kind") != "trades")
    seek = F.when(recent & (F.col("kind") == "snapshots"), F.col("high") - 1).when(recent, F.col("at_cutoff")).otherwise(F.col("high"))
    books = F.col("kind").isin("snapshots", "deltas") & (F.col("seek") < F.col("high"))
    return partitions.withColumn("kind", kind).where("kind is not null").withColumn("seek", seek).withColumn("drain_to",
        F.when(books, F.col("high") - 1))


def drained(records: DataFrame, plan: DataFrame, order: str) -> DataFrame:
    """The records from the one on that drains the last partition of a warm start: ``plan(topic, partition, drain_to)``."""
    need = plan.where("drain_to is not null").select("topic", "partition", "drain_to")
    reached = records.join(F.broadcast(need), ["topic", "partition"]).where(F.col("offset") >= F.col("drain_to")).groupBy("topic",
        "partition").agg(F.min(order).alias("at"))
    opened = need.join(reached, ["topic", "partition"], "left").agg(F.max("at").alias("_open"), F.count("*").alias("_n"),
        F.count("at").alias("_done"))
    gate = F.broadcast(opened)  # one row
    return records.join(gate, F.lit(True)).where((F.col("_n") == F.col("_done"))
        & (F.col("_open").isNull() | (F.col(order) >= F.col("_open")))).drop("_open", "_n", "_done")
