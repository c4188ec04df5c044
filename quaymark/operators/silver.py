"""Silver: facts and tapes projected from decoded log records, and read-back adapters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaymark.sources import wire

#: Datasets by what they carry.
BOOK_DATASETS = ("book_snapshots", "book_deltas")
TAPE_DATASETS = ("trades", "mark_price", "open_interest", "liquidations")
LATENCY_DATASETS = (*BOOK_DATASETS, *TAPE_DATASETS)
CROSSED_KINDS = ("snapshot_crossed", "crossed_after_delta")
_NUMBER = "decimal(38,18)"
#: Columns of a tape beyond its head, with their types; the messages hold numbers as strings.
TAPE = {
    "trades": {"trade_id": "string", "price": _NUMBER, "size": _NUMBER, "side": "string"},
    "mark_price": {"mark_price": _NUMBER, "index_price": _NUMBER, "est_settle_price": _NUMBER, "funding_rate": _NUMBER,
    "next_funding_ts_ns": "long"},
    "open_interest": {"open_interest": _NUMBER},
    "liquidations": {"side": "string", "price": _NUMBER, "avg_price": _NUMBER, "orig_size": _NUMBER, "filled_size": _NUMBER,
    "status": "string"},
}
TAGS = {"trades": "trade", "mark_price": "mark", "open_interest": "oi", "liquidations": "liq"}
HEAD = ["exchange", "canonical_symbol", "date", "ts_ns", "offset", "exchange_ts_ns", "local_ts_ns"]


def clock(recv: Column, local: Column) -> Column:
    """The time that rows of all venues share: the receive clock, or the emit clock where a record has none."""
    return F.coalesce(recv, local)


def built(records: DataFrame, dataset: str = "dataset") -> DataFrame:
    """What the silver build reads: tops and consolidated bests are validated live and passed over."""
    return records.where(F.col(dataset).isin(*LATENCY_DATASETS, "status"))


def latency(messages: DataFrame) -> DataFrame:
    """``messages(exchange, canonical_symbol, date, dataset, offset, exchange_ts_ns, local_ts_ns, recv_ns)``: a row for
    each that has an exchange clock and a receive time; locally made records (time 0) have no latency."""
    real = messages.where((F.col("exchange_ts_ns") != 0) & F.col("recv_ns").isNotNull())
    return real.select("exchange", "canonical_symbol", "date", "dataset", "offset", "exchange_ts_ns",
                       (F.col("recv_ns") - F.col("exchange_ts_ns")).alias("exchange_to_recv_ns"),
                       (F.col("local_ts_ns") - F.col("exchange_ts_ns")).alias("exchange_to_emit_ns"))


def tape(messages: DataFrame, dataset: str) -> DataFrame:
    """A tape dataset: the shared head on the shared clock, then the dataset's columns, numbers as decimals."""
    head = [c for c in HEAD if c != "ts_ns"]
    rows = messages.withColumn("ts_ns", clock(F.col("recv_ns"), F.col("local_ts_ns")))
    return rows.select(*HEAD[:3], "ts_ns", *head[3:], *[F.col(c).cast(k).alias(c) for c, k in TAPE[dataset].items()])


def decoded(records: DataFrame, instruments: DataFrame, dataset: str) -> DataFrame:
    """One pass over a tape's records: its columns and the latency columns of each message, numbers still strings.

    :func:`tape` and :func:`latency` are two selects of this; written once, it feeds both."""
    m = wire.decode(records, TAGS[dataset])
    rows = m.select(F.col("m.exchange").alias("exchange"), F.col("m.symbol").alias("symbol"),
        wire.record_date(F.col("timestamp_ms")).alias("date"), F.lit(dataset).alias("dataset"), "offset",
                    F.col("m.exchange_ts_ns").alias("exchange_ts_ns"), F.col("m.local_ts_ns").alias("local_ts_ns"),
                    wire.header("local_recv_ts_ns").alias("recv_ns"),
                    *[F.col(f"m.{c}").alias(c) for c in TAPE[dataset]])
    return wire.resolve(rows, instruments).withColumnRenamed("canonical", "canonical_symbol").drop("symbol")


def book_quality(events: DataFrame) -> DataFrame:
    """A row for each record of the fold: its clocks (an engine time of 0 is none), its touch and what was wrong."""
    return events.select(
        "exchange", "canonical_symbol", "date", "kind", "offset", "sequence", "epoch", "exchange_ts_ns",
        F.nullif("engine_ts_ns", F.lit(0)).alias("engine_ts_ns"), "local_ts_ns",
        "local_recv_ts_ns", "best_bid", "best_ask", "seq_gap", F.coalesce(F.col("invariant_kind").isin(*CROSSED_KINDS),
        F.lit(False)).alias("crossed"), "invariant_kind")


def quote_rows(events: DataFrame) -> DataFrame:
    """Tops of valid two-sided books on the shared clock; the other rows of the fold make no quote."""
    sound = events.where(F.col("invariant_kind").isNull() & F.col("best_bid").isNotNull() & F.col("best_ask").isNotNull())
    return sound.select("exchange", "canonical_symbol", "date", clock(F.col("local_recv_ts_ns"), F.col("local_ts_ns")).alias("ts_ns"),
        "best_bid", "best_ask", "bid_sz", "ask_sz")


def read_back(rows: DataFrame, *values: str) -> DataFrame:
    """``(ts_ns, v)``: a dataset as a stream of timed values, as merges take it."""
    return rows.select("ts_ns", F.struct(*values).alias("v"))


def doubles(rows: DataFrame) -> DataFrame:
    """Decimals as doubles, where research begins."""
    return rows.select(*[F.col(f.name).cast("double").alias(f.name) if f.dataType.typeName() == "decimal" else F.col(f.name)
        for f in rows.schema])


def both_legs(pairs: DataFrame, present: DataFrame) -> DataFrame:
    """The pairs of ``(base, usd, usdt)`` of which both legs are present: ``present(symbol)``."""
    have = present.select("symbol").distinct()
    return pairs.join(have.withColumnRenamed("symbol", "usd"), "usd", "left_semi").join(have.withColumnRenamed("symbol", "usdt"), "usdt",
        "left_semi").select(*pairs.columns)


def agrees(live: DataFrame, quotes: DataFrame, by: list[str], ts: str, order: str, cols: list[str]) -> DataFrame:
    """Captured live tops against the quote rebuilt at or before each: ``agree``, null where there is none yet."""
    from .asof import asof_join

    grid = live.select(*by, ts, *[F.col(c).alias(f"live_{c}") for c in cols])
    met = asof_join(grid.select(*by, ts).distinct(), quotes, by, ts, [order], cols)
    same = [F.col(f"live_{c}") == F.col(c) for c in cols]
    out = same[0]
    for s in same[1:]:
        out = out & s
    return grid.join(met, [*by, ts]).withColumn("agree", out)


def no_regression(rows: DataFrame, by: list[str], order: str, ts: str) -> DataFrame:
    """The rows as they are; fails where a time is below the one before it."""
    from pyspark.sql import Window

    back = F.col(ts) < F.lag(ts).over(Window.partitionBy(*by).orderBy(order))
    return rows.withColumn(ts, F.when(back,
        F.raise_error(F.concat(F.lit("time goes back at "), F.col(ts).cast("string"))).cast("long")).otherwise(F.col(ts)))


def totals(rows: DataFrame, dataset: str = "dataset") -> DataFrame:
    """Rows written by dataset, as a build reports them."""
    return rows.groupBy(dataset).agg(F.count("*").alias("n_rows"))
