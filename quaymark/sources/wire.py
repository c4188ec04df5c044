"""Log records and wire messages: topics, headers, decoding, timestamps, the jsonl corpus."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The log record and the fields of each message tag.
RECORD = "topic string, partition int, offset long, timestamp_ms long, key binary, value binary, headers array<struct<key:string,value:binary>>"
_BOOK = "t string, exchange string, symbol string, sequence long, bids array<array<string>>, asks array<array<string>>, exchange_ts_ns long, local_ts_ns long, epoch long, engine_ts_ns long"
MESSAGES = {
    "snap": _BOOK,
    "delta": _BOOK,
    "trade": "t string, exchange string, symbol string, trade_id string, price string, size string, side string, exchange_ts_ns long, local_ts_ns long",
    "bbo": "t string, exchange string, symbol string, bid_px string, bid_sz string, ask_px string, ask_sz string, exchange_ts_ns long, local_ts_ns long",
    "liq": "t string, exchange string, symbol string, side string, price string, avg_price string, orig_size string, filled_size string, status string, exchange_ts_ns long, local_ts_ns long",
    "mark": "t string, exchange string, symbol string, mark_price string, index_price string, est_settle_price string, funding_rate string, next_funding_ts_ns long, exchange_ts_ns long, local_ts_ns long",
    "oi": "t string, exchange string, symbol string, open_interest string, exchange_ts_ns long, local_ts_ns long",
    "status": "t string, exchange string, state string, ts_ns long",
}


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Log records from gzipped JSON lines with base64 bytes."""
    raw = spark.read.schema("topic string, partition int, offset long, timestamp_ms long, key string, value string, headers array<struct<key:string,value:string>>").json(path)
    heads = F.transform(F.coalesce("headers", F.array()), lambda h: F.struct(h["key"].alias("key"), F.unbase64(h["value"]).alias("value")))
    return raw.select("topic", "partition", "offset", "timestamp_ms", F.unbase64("key").alias("key"), F.unbase64("value").alias("value"),
        heads.alias("headers"))


def write_corpus(records: DataFrame, path: str) -> None:
    heads = F.transform(F.coalesce("headers", F.array()), lambda h: F.struct(h["key"].alias("key"), F.base64(h["value"]).alias("value")))
    records.select("topic", "partition", "offset", "timestamp_ms", F.base64("key").alias("key"), F.base64("value").alias("value"),
        heads.alias("headers")).write.option("compression", "gzip").json(path)


def decode(records: DataFrame, tag: str) -> DataFrame:
    """Messages of one tag, as columns of ``m`` beside the record's."""
    text = F.col("value").cast("string")
    return records.where(F.get_json_object(text, "$.t") == tag).withColumn("m", F.from_json(text, MESSAGES[tag]))


def header(name: str, headers: str = "headers") -> Column:
    """The first header of that name as a long; null if there is none."""
    return F.get(F.filter(headers, lambda h: h["key"] == name), F.lit(0))["value"].cast("string").cast("long")


def normalized(symbol: Column) -> Column:
    return F.regexp_replace(symbol, "[^a-zA-Z0-9._-]", "-")


def topic_parts(topic: Column, datasets: list[str]) -> Column:
    """``struct(dataset, exchange, symbol)`` of ``<dataset>.<exchange>[.<symbol>]``; unknown datasets fail.

    The exchange ends at the first dot; the symbol may hold more."""
    m = lambda i: F.regexp_extract(topic, "^([^.]+)\\.([^.]+)(?:\\.(.*))?$", i)
    known = m(1).isin(datasets)
    return F.struct(F.when(known, m(1)).otherwise(F.raise_error(F.concat(F.lit("unknown topic "), topic)).cast("string")).alias("dataset"),
        m(2).alias("exchange"), F.nullif(m(3), F.lit("")).alias("symbol"))


def record_date(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd")


def rfc3339_ns(text: Column) -> Column:
    """Epoch nanoseconds of an RFC 3339 time with up to nine fraction digits."""
    zone = F.regexp_extract(text, "(Z|[+-][0-9]{2}:[0-9]{2})$", 1)
    frac = F.rpad(F.regexp_extract(text, "\\.([0-9]{1,9})", 1), 9, "0")
    head = F.regexp_extract(text, "^([0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2})", 1)
    return F.unix_seconds(F.to_timestamp(F.concat(head, zone))) * 1_000_000_000 + frac.cast("long")


def levels(col: Column) -> Column:
    return F.transform(col, lambda x: F.struct(x[0].alias("px"), x[1].alias("sz")))


def book_records(records: DataFrame) -> DataFrame:
    """Snapshots and deltas of a log as input of the book fold."""
    parts = [decode(records, t).select(F.col("m.exchange").alias("exchange"), F.col("m.symbol").alias("symbol"),
        record_date(F.col("timestamp_ms")).alias("date"), F.lit(t).alias("kind"), "offset",
             F.col("m.sequence").alias("sequence"), F.coalesce("m.epoch", F.lit(0)).cast("long").alias("epoch"),
             F.coalesce(header("local_recv_ts_ns"), F.col("m.local_ts_ns")).alias("ts_ns"),
             levels(F.col("m.bids")).alias("bids"), levels(F.col("m.asks")).alias("asks")) for t in ("snap", "delta")]
    return reduce(DataFrame.unionByName, parts)


def resolve(rows: DataFrame, instruments: DataFrame) -> DataFrame:
    """``canonical``: the instrument of (exchange, normalized symbol), or that symbol if it is not declared.

    The instrument table has one row per declared venue symbol and is broadcast."""
    ref = instruments.select(F.col("exchange").alias("_ex"), normalized(F.col("symbol")).alias("_sym"), F.col("canonical").alias("_canon"))
    out = rows.withColumn("_n", normalized(F.col("symbol")))
    return out.join(F.broadcast(ref), (F.col("exchange") == F.col("_ex")) & (F.col("_n") == F.col("_sym")), "left").withColumn("canonical",
        F.coalesce("_canon", "_n")).drop("_ex", "_sym", "_canon", "_n")


def pairs_by_base(instruments: DataFrame) -> DataFrame:
    """Bases with a USD and a USDT spot instrument: ``(base, usd, usdt)``."""
    spot = instruments.where(~F.col("canonical").endswith("-PERP")).select("base", "quote", "canonical").distinct()
    return spot.groupBy("base").pivot("quote", ["USD",
        "USDT"]).agg(F.min("canonical")).where("USD is not null and USDT is not null").select("base", F.col("USD").alias("usd"),
        F.col("USDT").alias("usdt"))
