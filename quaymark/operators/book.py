"""Order books: the ordered fold of snapshots and deltas, per (exchange, symbol, date)."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from decimal import Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RUNGS = (5, 10)
CONTIGUOUS = ("kraken",)
EVENTS = ("exchange string, symbol string, date string, kind string, offset long, sequence long, epoch long, ts_ns long, best_bid decimal(38,18), best_ask decimal(38,18), "
          "bid_sz decimal(38,18), ask_sz decimal(38,18), seq_gap long, invariant_kind string, crossed boolean, quoted boolean, "
          "bid_depth_5 decimal(38,18), ask_depth_5 decimal(38,18), bid_depth_10 decimal(38,18), ask_depth_10 decimal(38,18), bid_px_10 decimal(38,18), ask_px_10 decimal(38,18)")


class Ladder:
    """Prices and sizes of one side, best first: ``sign`` -1 for bids, 1 for asks."""

    def __init__(self, sign: int, levels: Iterable[tuple[Decimal, Decimal]] = ()) -> None:
        self.sign = sign
        self.sizes = {sign * p: s for p, s in levels if s > 0}
        self.keys = sorted(self.sizes)

    def put(self, price: Decimal, size: Decimal) -> None:
        key = self.sign * price
        known = key in self.sizes
        if size == 0:
            if known:
                del self.sizes[key]
                del self.keys[bisect_left(self.keys, key)]
            return
        self.sizes[key] = size
        if not known:
            insort(self.keys, key)

    def best(self, n: int) -> list[tuple[Decimal, Decimal]]:
        return [(self.sign * k, self.sizes[k]) for k in self.keys[:n]]

    def cut(self, depth: int) -> list[Decimal]:
        """Keep the best ``depth`` levels; the prices that went, the worst first."""
        gone, self.keys = self.keys[depth:], self.keys[:depth]
        for k in gone:
            del self.sizes[k]
        return [self.sign * k for k in reversed(gone)]


class Book:
    """Both sides of a book, and the last sequence applied (-1: none)."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.bids, self.asks, self.sequence = Ladder(-1), Ladder(1), -1

    @staticmethod
    def _cross(bids: Ladder, asks: Ladder) -> bool:
        """Whether the best bid is at or above the best ask."""
        return bool(bids.keys and asks.keys) and -bids.keys[0] >= asks.keys[0]

    def crossed(self) -> bool:
        return self._cross(self.bids, self.asks)

    def snapshot(self, sequence: int, bids: list, asks: list) -> str | None:
        """Replace the book; a crossed snapshot leaves it as it is and is named."""
        new = Ladder(-1, bids), Ladder(1, asks)
        if self._cross(*new):
            return "snapshot_crossed"
        (self.bids, self.asks), self.sequence = new, sequence
        return None

    def delta(self, sequence: int, bids: list, asks: list) -> str | None:
        """Set or delete levels; what breaks an invariant is named. A book crossed by a delta keeps its levels."""
        if sequence <= self.sequence:
            return "non_monotonic_seq"
        for price, size in bids:
            self.bids.put(price, size)
        for price, size in asks:
            self.asks.put(price, size)
        if self.crossed():
            return "crossed_after_delta"
        self.sequence = sequence
        return None

    def top(self, n: int) -> tuple[list, list]:
        return self.bids.best(n), self.asks.best(n)

    def depth(self) -> tuple[int, int]:
        return len(self.bids.keys), len(self.asks.keys)

    def trim(self, depth: int) -> tuple[list, list]:
        """Keep the best ``depth`` levels a side; the prices that went."""
        return self.bids.cut(depth), self.asks.cut(depth)


def fold(records: Iterable, contiguous: bool) -> Iterator[tuple]:
    """``(record, gap, violation, bids, asks)`` for each record of one stretch of a book, in fold order.

    A violation empties the book after its row, and later deltas go on from there. A delta at the
    book's own sequence is already in it.
    """
    book = Book()
    for r in records:
        at, gap, wrong = book.sequence, 0, None
        if r.kind == "snap":
            wrong = book.snapshot(r.sequence, r.bids, r.asks)
        elif r.sequence != at:
            gap = max(0, r.sequence - at - 1) if contiguous and at >= 0 else 0
            wrong = book.delta(r.sequence, r.bids, r.asks)
        yield r, gap, wrong, *book.top(RUNGS[-1])
        if wrong:
            book.clear()


def _levels(raw) -> list[tuple[Decimal, Decimal]]:
    return [(Decimal(x["px"]), Decimal(x["sz"])) for x in (raw if raw is not None else ())]


#: The order of the fold: by epoch and sequence, a snapshot before a delta of its own sequence.
ORDER = ["epoch", "sequence", "late", "offset"]


def stretches(records: DataFrame) -> DataFrame:
    """``late`` and ``stretch``: runs of a book's records that need no state from before.

    A new epoch starts an empty book, and a snapshot that is not crossed replaces whatever there was: so a
    hot book's date is many groups, each from one such snapshot to the next. Fails where the offsets
    of a kind do not rise in the order of the fold."""
    rows = records.withColumn("late", (F.col("kind") != "snap").cast("int"))
    by = ["exchange", "symbol", "date"]
    before = F.lag("offset").over(Window.partitionBy(*by, "kind").orderBy("epoch", "sequence", "offset"))
    wrong = F.raise_error(F.concat(F.lit("records out of order at offset "), F.col("offset").cast("string"))).cast("long")
    price = lambda side: F.transform(F.filter(side, lambda x: x["sz"].cast("decimal(38,18)") > 0),
        lambda x: x["px"].cast("decimal(38,18)"))
    sound = (F.col("kind") == "snap") & ~F.coalesce(F.array_max(price("bids")) >= F.array_min(price("asks")), F.lit(False))
    n = F.sum(sound.cast("long")).over(Window.partitionBy(*by, "epoch").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_before", before).withColumn("offset",
        F.when(F.col("_before") > F.col("offset"), wrong).otherwise(F.col("offset"))).drop("_before").withColumn("stretch", n)


def fold_books(records: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The fold of every book, one row per record with what the book then shows (``EVENTS``, then ``carry``).

    ``records(exchange, symbol, date, kind, offset, sequence, epoch, ts_ns, bids, asks)``, levels
    as arrays of ``struct<px:string,sz:string>``; ``carry`` names columns that go along as they are. A group is
    one of :func:`stretches`; inside it the state is sequential.
    """
    kinds = EVENTS + "".join(f", {c} {records.schema[c].dataType.simpleString()}" for c in carry)
    names = [c.split()[0] for c in EVENTS.split(", ")] + list(carry)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(ORDER, kind="stable")
        pdf = pdf.assign(bids=pdf["bids"].map(_levels), asks=pdf["asks"].map(_levels))
        rows = []
        for r, gap, wrong, bids, asks in fold(pdf.itertuples(index=False), pdf["exchange"].iloc[0] in CONTIGUOUS):
            b, a = (bids[0] if bids else (None, None)), (asks[0] if asks else (None, None))
            quoted = wrong is None and bool(bids) and bool(asks)
            depth = [sum((s for _, s in side[:n]), Decimal(0)) if quoted else None for n in RUNGS for side in (bids, asks)]
            rows.append((r.exchange, r.symbol, r.date, r.kind, r.offset, r.sequence, r.epoch, r.ts_ns, b[0], a[0], b[1], a[1], gap, wrong,
                         wrong in ("snapshot_crossed", "crossed_after_delta"), quoted, *depth, bids[-1][0] if quoted else None,
                         asks[-1][0] if quoted else None, *[getattr(r, c) for c in carry]))
        out = pd.DataFrame(rows, columns=names)
        return out.astype({c: "Int64" for c in carry if pd.api.types.is_numeric_dtype(out[c])})

    cols = ["exchange", "symbol", "date", "kind", "offset", "sequence", "epoch", "ts_ns", "bids", "asks"]
    return stretches(records.select(*cols, *carry)).groupBy("exchange", "symbol", "date", "epoch", "stretch").applyInPandas(run, kinds)


def quotes(events: DataFrame) -> DataFrame:
    """Tops of valid two-sided books, with depth at the rungs and the worst price reached."""
    return events.where("quoted").select("exchange", "symbol", "date", "ts_ns", "best_bid", "best_ask", "bid_sz", "ask_sz",
        *[f"{s}_depth_{n}" for n in RUNGS for s in ("bid", "ask")], "bid_px_10", "ask_px_10")


def kraken_checksum(bids: Column, asks: Column) -> Column:
    """CRC32 over the ten best asks, then bids: price and size without dot and leading zeros."""
    def side(levels):
        bare = lambda s: F.regexp_replace(F.regexp_replace(s, "\\.", ""), "^0+", "")
        return F.concat_ws("", F.transform(F.slice(levels, 1, 10), lambda x: F.concat(bare(x["px"]), bare(x["sz"]))))
    return F.crc32(F.concat(side(asks), side(bids)).cast("binary"))
