"""Helpers that several operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of the whitespace word class ``[^\x20\x09-\x0D]+``.
SPACES = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local session (tests) gets a temporary folder; a cluster has to name one.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="quaymark-")
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """``df`` as a table in the shared folder: computed once, its lineage cut, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quaymark-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quaymark_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files behind a table that :func:`written` made and that nothing reads any more."""
    path = getattr(df, "_quaymark_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def meet(rows: DataFrame, groups: DataFrame, key: str, salt: Column, parts: int = 512) -> DataFrame:
    """``rows`` left-joined with ``groups(key, n, ...)``, one row per key, without a task for a hot key.

    The columns of ``groups`` that ``rows`` has not are added. ``n`` is how many of the rows have the key. At most ``parts`` keys can hold more than a
    ``parts``-th of what ``groups`` counts: those are broadcast, and their rows dealt by ``salt``. The
    other keys meet in a shuffle. Keys are strings.
    """
    total = groups.agg(F.sum("n")).first()[0] or 0
    names = [c for c in groups.columns if c != key and c not in rows.columns]
    found = F.struct(*names)
    hot = groups.where(F.col("n") * parts > total).select(key, found.alias("_hot"))
    cold = groups.where(F.col("n") * parts <= total).select(F.col(key).alias("_k"), found.alias("_cold"))
    dealt = F.when(F.col("_hot").isNotNull(), F.concat(F.lit("#"), salt.cast("string"))).otherwise(F.col(key))
    out = rows.join(F.broadcast(hot), key, "left").withColumn("_dealt", dealt).join(cold, F.col("_dealt") == F.col("_k"), "left")
    got = F.coalesce("_hot", "_cold")
    return out.select(*rows.columns, *[got[c].alias(c) for c in names])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph by alternating large-star and small-star.

    ``edges(u long, v long)``; nulls and self links are ignored. Returns ``(node long,
    component long)`` for every node with a link, where component is the least node
    reachable. Each round is a few keyed joins and aggregations of the edge list; the list
    is cut as a table in the shared folder after each round and never reaches the driver.
    """
    e = written(
        edges.where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.where("u <> v")
        root = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(root, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("p"))
            .select(F.col("p.v").alias("u"), F.col("p.m").alias("v")).where("u <> v").distinct()
        )
        new = written(small, "edges")
        state = new.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        forget(e)
        e = new
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
