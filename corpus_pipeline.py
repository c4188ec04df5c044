"""A training corpus from ``documents``, in stages that each write a table for the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaymark.llm import decontam, mixing, pii, simhash, toxicity
from quaymark.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _columns(docs: DataFrame) -> list:
    return [F.col("row")[c].alias(c) for c in docs.columns]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier does not reject."""
    scored = toxicity.score(docs, table(spark, sf_dir, "labels"), whole=True)
    return scored.where("predicted = 0").select(*_columns(docs))


def _free(docs: DataFrame, name: str) -> str:
    """``name``, or that with a prefix, so that no column of ``docs`` has it in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"mix_{name}"
    return name


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a name of each row's own, and that column's name: ids may be null or repeat.

    Rows of Parquet files are named by their file and place in it, which every reading finds again; others
    by numbers, for which they are written to a table first.
    """
    row = _free(docs, "_row")
    try:
        if "_metadata" not in docs.columns:
            file, place = F.md5(F.col("_metadata.file_path").cast("binary")), F.col("_metadata.row_index").cast("string")
            return docs.select("*", F.concat_ws(":", file, place).alias(row)), row
    except AnalysisException:  # no files behind it, or files of another kind
        pass
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each SimHash component: the one with the smallest doc_id (null last), then text hash."""
    rows, row = _numbered(docs)
    found = simhash.near_duplicates(rows, id_col=row).select(F.col("doc_id").alias(row), "component_id")
    keys = rows.select(row, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("hash"),
        F.col(row).alias("n")).alias("key"))
    kept = found.join(keys, row).groupBy("component_id").agg(F.min("key").alias("key")).select(F.col("key.n").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows that benchmark items do not contaminate, each by its own text."""
    rows, row = _numbered(docs)
    hit = decontam.contamination(rows, table(spark, sf_dir, "benchmark"),
        id_col=row).where("contaminated").select(F.col("doc_id").alias(row))
    return rows.join(hit, row, "left_anti").select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each span of personal data replaced by its kind; n_chars follows the text."""
    out = pii.masked(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNotNull(),
        F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the mix's columns and ``copies``, how often.

    A column of the mix whose name the documents have is called ``mix_`` and that name.
    """
    rows, row = _numbered(docs)
    mixed = mixing.mix(rows, key_col=row).where("taken > 0")
    added = {"size": F.col("size"), "source_size": F.col("source_size"), "target": F.col("target"), "taken": F.col("taken"),
        "copies": F.expr("taken div size")}
    narrow = mixed.select(F.col("key").alias("_key"), F.struct(*[v.alias(k) for k, v in added.items()]).alias("_mix"))
    met = rows.select(F.col(row).alias("_key"), F.struct(*docs.columns).alias("_doc")).join(narrow, "_key")
    return met.select(*[F.col("_doc")[c].alias(c) for c in docs.columns], *[F.col("_mix")[k].alias(_free(docs, k)) for k in added])


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", mask_personal_data),
    ("mixing", mix_sources),
]

#: The first stage's classifier is beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
