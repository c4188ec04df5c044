"""The lake: partitioned Parquet datasets with declared schemas, markers, and listings.

Path keys are copies of columns named ``p_<column>``, so that the columns stay in the files and a
filter on a key lists only the folders it names.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TAPE = "exchange string, canonical_symbol string, date string, ts_ns long, offset long, exchange_ts_ns long, local_ts_ns long, "
_D = "decimal(38,18)"
_RECORD = "topic string, partition int, offset long, timestamp_ms long, key binary, value binary, headers array<struct<key:string,value:binary>>"
_DEPTH = ", ".join(f"{s}_depth_{n} {_D}" for n in (5, 10) for s in ("bid", "ask"))
_STATS = ", ".join(f"basis_bps_{s} double" for s in ("mean", "std", "median", "min", "max", "p1", "p99"))
#: The log's datasets, the topics that feed them, and the keys of their paths besides the date.
BRONZE = {
    "book_snapshots": ("md.book.*.snapshots", ("exchange", "symbol")), "book_deltas": ("md.book.*.deltas", ("exchange", "symbol")),
    "trades": ("md.trades.*", ("exchange", "symbol")),
    "bbo": ("md.bbo.*", ("exchange", "symbol")), "liquidations": ("md.liquidations.*", ("exchange", "symbol")),
    "mark_price": ("md.markprice.*", ("exchange", "symbol")),
    "open_interest": ("md.openinterest.*", ("exchange", "symbol")), "status": ("md.status.*", ("exchange",)),
    "nbbo": ("md.nbbo.*", ("symbol",)),
}
#: The datasets by (layer, name).
SCHEMAS = {
    **{("bronze", name): _RECORD for name in BRONZE},
    ("silver", "book_quality"): ("exchange string, canonical_symbol string, date string, kind string, offset long, sequence long, epoch long, exchange_ts_ns long, engine_ts_ns long, local_ts_ns long, "
                                 f"local_recv_ts_ns long, best_bid {_D}, best_ask {_D}, seq_gap long, crossed boolean, invariant_kind string"),
    ("silver", "latency"): "exchange string, canonical_symbol string, date string, dataset string, offset long, exchange_ts_ns long, exchange_to_recv_ns long, exchange_to_emit_ns long",
    ("silver", "status_events"): "exchange string, date string, ts_ns long, state string, prev_state string, is_transition boolean, downtime_ns long",
    ("silver", "quotes"): f"exchange string, canonical_symbol string, date string, ts_ns long, best_bid {_D}, best_ask {_D}, bid_sz {_D}, ask_sz {_D}, {_DEPTH}, bid_px_10 {_D}, ask_px_10 {_D}",
    ("silver", "nbbo"): f"canonical_symbol string, date string, ts_ns long, best_bid {_D}, best_ask {_D}, bid_venue string, ask_venue string, n_venues long",
    ("silver", "trades"): f"{_TAPE}trade_id string, price {_D}, size {_D}, side string",
    ("silver", "mark_price"): f"{_TAPE}mark_price {_D}, index_price {_D}, est_settle_price {_D}, funding_rate {_D}, next_funding_ts_ns long",
    ("silver", "open_interest"): f"{_TAPE}open_interest {_D}",
    ("silver", "liquidations"): f"{_TAPE}side string, price {_D}, avg_price {_D}, orig_size {_D}, filled_size {_D}, status string",
    ("gold", "basis"): f"base string, date string, ts_ns long, usd_mid {_D}, usdt_mid {_D}, basis_abs {_D}, basis_bps double, usd_bid {_D}, usd_ask {_D}, usdt_bid {_D}, usdt_ask {_D}",
    ("gold", "basis_summary"): f"base string, date string, n_obs long, {_STATS}, coverage_ns long",
    ("gold", "scorecard"): "exchange string, canonical_symbol string, date string, check string, n_records long, n_violations long, p50_ms double, p95_ms double, p99_ms double, detail string",
}
MARKER = "dataset string, date string, written_at_epoch double, row_count long"


def schema(layer: str, name: str) -> T.StructType:
    """The declared schema of a dataset; an unknown one is an error."""
    if (layer, name) not in SCHEMAS:
        raise KeyError(f"no dataset {layer}.{name}")
    return T.StructType.fromDDL(SCHEMAS[layer, name])


def datasets(layer: str) -> list[str]:
    return [name for at, name in SCHEMAS if at == layer]


def decimals(layer: str, name: str) -> list[str]:
    """The columns of a dataset that are exact decimals."""
    return re.findall(r"(\w+) decimal\(", SCHEMAS[layer, name])


def checked(df: DataFrame, layer: str, name: str) -> DataFrame:
    """``df`` in the declared column order and types; missing or extra columns are an error."""
    want = schema(layer, name)
    if set(df.columns) != set(want.names):
        raise ValueError(f"{layer}.{name}: missing {sorted(set(want.names) - set(df.columns))}, extra {sorted(set(df.columns) - set(want.names))}")
    return df.select(*[F.col(f.name).cast(f.dataType) for f in want])


def write(df: DataFrame, base: str, layer: str, name: str, by: list[str], markers: bool = True) -> None:
    """Overwrite the partitions that ``df`` has, all or nothing, then mark each date as fresh.

    The marker counts what was written, by reading it back; a dataset without a row gets none."""
    out = checked(df, layer, name)
    for c in by:
        out = out.withColumn(f"p_{c}", F.col(c))
    path = f"{base}/{layer}/{name}"
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression",
        "zstd").partitionBy(*[f"p_{c}" for c in by]).parquet(path)
    if markers and "date" in by:
        mark(df.sparkSession.read.parquet(path), base, layer, name)


def mark(rows: DataFrame, base: str, layer: str, name: str) -> None:
    """Mark a dataset's dates as written now: one small file of markers for a dataset, replaced whole."""
    now = F.unix_micros(F.current_timestamp()).cast("double") / 1e6
    out = rows.groupBy(F.col("p_date").cast("string").alias("date")).agg(F.count("*").alias("row_count"))
    out = out.select(F.lit(name).alias("dataset"), "date", now.alias("written_at_epoch"), "row_count", F.lit(name).alias("p_dataset"))
    out.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode",
        "dynamic").partitionBy("p_dataset").parquet(f"{base}/{layer}/_freshness")


def read(spark: SparkSession, base: str, layer: str, name: str, **keys: str) -> DataFrame:
    """A dataset under its declared schema and no other columns: those that old files lack are null.

    ``keys`` name path keys (``date="2024-01-01"``): only the folders of those are listed and read."""
    declared = schema(layer, name)
    files = spark.read.schema(T.StructType([*declared,
        *[T.StructField(f"p_{k}", T.StringType()) for k in keys]])).parquet(f"{base}/{layer}/{name}")
    for k, v in keys.items():
        files = files.where(F.col(f"p_{k}") == v)
    return files.select(*declared.names)


def read_ordered(spark: SparkSession, base: str, name: str, date: str) -> DataFrame:
    """A date of a log dataset in the order of the log: by topic, partition and offset."""
    return read(spark, base, "bronze", name, date=date).orderBy("topic", "partition", "offset")


def partitions(spark: SparkSession, base: str, layer: str, name: str) -> list[dict[str, str]]:
    """The path keys of a dataset's folders, from a listing alone: no file is opened."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{base}/{layer}/{name}")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    out, todo = [], [(root, {})]
    while todo:
        path, keys = todo.pop()
        below = [s for s in fs.listStatus(path) if s.isDirectory() and re.match(r"p_\w+=", s.getPath().getName())]
        if not below and keys:
            out.append(keys)
        for s in below:
            key, _, value = s.getPath().getName().partition("=")
            todo.append((s.getPath(), {**keys, key[2:]: value}))
    return sorted(out, key=lambda k: sorted(k.items()))


def latest_date(spark: SparkSession, base: str, layer: str, name: str) -> str | None:
    """The newest date that a dataset has a folder for."""
    return max((p["date"] for p in partitions(spark, base, layer, name) if "date" in p), default=None)


def read_markers(spark: SparkSession, base: str, layer: str) -> DataFrame:
    """The markers of a layer; none if nothing was ever marked."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{base}/{layer}/_freshness")
    if not root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], MARKER)
    return spark.read.schema(MARKER).parquet(f"{base}/{layer}/_freshness").select("dataset", "date", "written_at_epoch", "row_count")


def newest_files(spark: SparkSession, base: str, layer: str, names: list[str]) -> DataFrame:
    """``(layer, dataset, at)``: when the newest file of each dataset's latest date was written, from file metadata."""
    from functools import reduce

    parts = []
    for name in names:
        date = latest_date(spark, base, layer, name)
        if date is not None:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter",
                "*.parquet").load(f"{base}/{layer}/{name}")
            files = files.where(F.col("path").contains(f"p_date={date}"))
            parts.append(files.agg(F.max(F.unix_micros("modificationTime").cast("double") / 1e6).alias("at")).select(F.lit(layer).alias("layer"), F.lit(name).alias("dataset"), "at"))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "layer string, dataset string, at double")


def freshness(markers: DataFrame, now: float) -> DataFrame:
    return markers.groupBy("dataset").agg(F.greatest(F.lit(0.0), F.lit(now) - F.max("written_at_epoch")).alias("freshness_seconds"))


def layer_at(spark: SparkSession, base: str, layer: str, names: list[str]) -> DataFrame:
    """``(layer, dataset, at)`` of a derived layer: by its markers, or by its files where it has none yet."""
    marks = read_markers(spark, base, layer)
    if marks.isEmpty():
        return newest_files(spark, base, layer, names)
    return marks.groupBy("dataset").agg(F.max("written_at_epoch").alias("at")).select(F.lit(layer).alias("layer"), "dataset", "at")


def roots(settings: Mapping[str, str], layers: tuple[str, ...] = ("bronze", "silver", "gold")) -> dict[str, str]:
    """Where each layer lives: its own root, or the common one; neither is an error."""
    out = {}
    for layer in layers:
        at = settings.get(f"lake.{layer}.root") or settings.get("lake.root")
        if not at:
            raise ValueError(f"lake.{layer}.root or lake.root must be set")
        out[layer] = at
    return out


def manifest(records: DataFrame) -> DataFrame:
    """Per topic, partition and date: the offsets and rows of its chunk, and its file name."""
    out = records.groupBy("topic", "partition", F.date_format(F.timestamp_millis("timestamp_ms"),
        "yyyy-MM-dd").alias("date")).agg(F.min("offset").alias("start_offset"), F.max("offset").alias("end_offset"),
        F.count("*").alias("n_records"))
    return out.withColumn("file", F.format_string("%03d-%012d.parquet", "partition", "start_offset"))


def contract(layer: str) -> str:
    """The layer's datasets and columns as a document, rendered from the registry."""
    lines = ["| Dataset | Column | Type |", "|---|---|---|"]
    shown: set[str] = set()
    for name in datasets(layer):
        if SCHEMAS[layer, name] in shown:
            lines.append(f"| `{name}` | as above | |")
            continue
        shown.add(SCHEMAS[layer, name])
        lines += [f"| `{name}` | `{c}` | {k} |" for c, k in re.findall(r"(\w+) ((?:array<.*>|decimal\(\d+,\d+\)|\w+))(?:, |$)",
            SCHEMAS[layer, name])]
    return "\n".join(lines)


def drifted(text: str, layer: str) -> list[str]:
    """The lines of a written document that the registry does not say any more, and the other way round."""
    have, want = set(text.strip().splitlines()), set(contract(layer).splitlines())
    return sorted(have ^ want)
