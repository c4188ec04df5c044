"""The log as files: chunks, capture, replay, topics, message encoding, and the instrument table."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .wire import normalized

CHUNK = "topic string, partition int, chunk long, date string, start_offset long, end_offset long, n_records long, value_bytes long, cause string, object_key string"


def topic(kind: str, exchange: Column | None = None, symbol: Column | None = None) -> Column:
    """The topic of a kind of message: ``md.book.<exchange>.<symbol>.snapshots`` and the like; symbols are normalized."""
    one = {"snapshots": ("md.book", ".snapshots"), "deltas": ("md.book", ".deltas"), "trades": ("md.trades", ""), "bbo": ("md.bbo", ""),
        "liquidations": ("md.liquidations", ""),
           "mark_price": ("md.markprice", ""), "open_interest": ("md.openinterest", ""), "status": ("md.status", ""),
           "nbbo": ("md.nbbo", "")}
    head, tail = one[kind]
    parts = [F.lit(head)]
    if exchange is not None:
        parts.append(exchange)
    if symbol is not None:
        parts.append(normalized(symbol))
    return F.concat(F.concat_ws(".", *parts), F.lit(tail))


def encoded(messages: DataFrame, tag: str, columns: list[str]) -> DataFrame:
    """``value``: each row as a tagged message, nulls left out."""
    return messages.withColumn("value", F.to_json(F.struct(F.lit(tag).alias("t"), *columns)).cast("binary"))


def latency_headers(recv_ns: Column, exchange_ts_ns: Column) -> Column:
    """The two clocks of a record as its headers, in ASCII."""
    pair = lambda k, v: F.struct(F.lit(k).alias("key"), v.cast("string").cast("binary").alias("value"))
    return F.array(pair("local_recv_ts_ns", recv_ns), pair("exchange_ts_ns", exchange_ts_ns))


def from_log(messages: DataFrame) -> DataFrame:
    """Records of a broker as records of a corpus: no headers are an empty list."""
    return messages.select("topic", "partition", "offset", "timestamp_ms", "key", "value",
                           F.coalesce("headers", F.array().cast("array<struct<key:string,value:binary>>")).alias("headers"))


def captured(records: DataFrame, order: list[str], max_records: int | None = None, duration_ms: int | None = None) -> DataFrame:
    """A capture window: records in ``order`` up to ``max_records``, and within ``duration_ms`` of the first."""
    out = records
    if duration_ms is not None:
        first = records.agg(F.min("timestamp_ms").alias("_first"))
        out = out.join(F.broadcast(first), F.lit(True)).where(F.col("timestamp_ms") - F.col("_first") < duration_ms).drop("_first")
    return out.orderBy(*order).limit(max_records) if max_records is not None else out


def paced(records: DataFrame, by: list[str], order: list[str], speed: float, elapsed: str | None = None) -> DataFrame:
    """``delay_sec``: how long a replay at ``speed`` waits before each record, given the seconds it has spent; never below 0."""
    first = F.first("timestamp_ms").over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    spent = F.lit(0.0) if elapsed is None else F.col(elapsed)
    return records.withColumn("delay_sec", F.greatest(F.lit(0.0), (F.col("timestamp_ms") - first) / 1000.0 / speed - spent))


def dropped(records: DataFrame, path: str, batch: int) -> int:
    """Replay into a folder that a file stream reads: files of ``batch`` records, in the order of the log; how many."""
    numbered = records.withColumn("_n", F.row_number().over(Window.orderBy("topic", "partition", "offset")) - 1)
    numbered.withColumn("drop", F.expr(f"_n div {batch}")).drop("_n").repartitionByRange("drop").sortWithinPartitions("drop", "topic",
        "partition", "offset").write.mode("append").partitionBy("drop").parquet(path)
    return records.count()


def chunks(records: DataFrame, most_bytes: int = 16 << 20, most_ms: int = 900_000) -> DataFrame:
    """How a partition's records are cut into files: ``CHUNK``, one row a file.

    ``records(topic, partition, offset, timestamp_ms, size, poll_ms)``: ``poll_ms`` is when the record was read. A file is
    closed before a record of another date, by a record that fills it to ``most_bytes``, and at the first read
    ``most_ms`` after its first record; what is left is closed at the end. Its key starts with the offset of
    its first record, so that writing it again replaces it. The cuts follow one another, so each partition of
    a topic is one group; only sizes and times are in it."""

    def cut(pdf: pd.DataFrame) -> pd.DataFrame:
        rows, held = [], None

        def close(cause: str) -> None:
            nonlocal held
            if held is not None:
                part = int(pdf["partition"].iloc[0])
                key = f"{held['date']}/{part:03d}-{held['start']:012d}.parquet"
                rows.append((pdf["topic"].iloc[0], part, len(rows), held["date"], held["start"], held["end"], held["n"], held["bytes"],
                    cause, key))
                held = None

        for r in pdf.sort_values("offset").itertuples(index=False):
            if held is not None and r.poll_ms - held["since"] >= most_ms:
                close("age")
            if held is not None and held["date"] != r.date:
                close("date")
            if held is None:
                held = {"date": r.date, "start": r.offset, "end": r.offset, "n": 0, "bytes": 0, "since": r.poll_ms}
            held["end"], held["n"], held["bytes"] = r.offset, held["n"] + 1, held["bytes"] + r.size
            if held["bytes"] >= most_bytes:
                close("size")
        close("end")
        return pd.DataFrame(rows, columns=[c.split()[0] for c in CHUNK.split(", ")])

    date = F.date_format(F.timestamp_millis("timestamp_ms"), "yyyy-MM-dd").alias("date")
    return records.select("topic", "partition", "offset", date, "size", "poll_ms").groupBy("topic", "partition").applyInPandas(cut, CHUNK)


def instruments(spark: SparkSession, text: str) -> DataFrame:
    """``(canonical, base, quote, exchange, symbol)`` from an instrument file in YAML.

    A missing field, a venue entry without exchange or symbol, and a venue symbol that is declared twice are errors."""
    import yaml

    doc = yaml.safe_load(text)
    if not isinstance(doc, dict) or not isinstance(doc.get("instruments"), dict):
        raise ValueError("an instrument file has a mapping under instruments")
    rows, owner = [], {}
    for canonical, spec in doc["instruments"].items():
        if not spec.get("base") or not spec.get("quote") or not isinstance(spec.get("venues"), list):
            raise ValueError(f"{canonical} lacks base, quote or venues")
        for venue in spec["venues"]:
            key = venue.get("exchange"), venue.get("symbol")
            if not all(key):
                raise ValueError(f"{canonical} has a venue without exchange or symbol")
            if key in owner:
                raise ValueError(f"{key[0]} {key[1]} is declared for {owner[key]} and {canonical}")
            owner[key] = canonical
            rows.append((canonical, spec["base"], spec["quote"], *key))
    return spark.createDataFrame(rows, "canonical string, base string, quote string, exchange string, symbol string")


def declared(table: DataFrame) -> DataFrame:
    """The partitions that a whole date has: every declared venue of every instrument."""
    return table.select("exchange", F.col("canonical").alias("canonical_symbol")).distinct()
