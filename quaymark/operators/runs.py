"""Runs: what was computed from what, kept so that two runs can be held against each other, and feature caches by content."""

from __future__ import annotations

import hashlib
import json
import math
import subprocess
from collections.abc import Callable, Iterable, Mapping
from importlib.metadata import PackageNotFoundError, version
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What makes two runs one experiment, and of that what names its direction.
EXPERIMENT = ("dates", "symbol", "extra_symbols", "horizon", "target", "spread_col", "predict_venue", "max_age_ms", "min_train",
    "test_size", "step", "coverages", "dead_zone_spreads")
DIRECTION = ("predict_venue", "target", "spread_col")


def digest(data: bytes | Iterable[str], size: int = 8) -> str:
    """A BLAKE2b digest of bytes, or of sorted lines."""
    raw = data if isinstance(data, bytes) else "\n".join(sorted(data)).encode()
    return hashlib.blake2b(raw, digest_size=size).hexdigest()


def file_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, sha256)`` of every file below ``paths``, read on the executors: of content, so that a copy is no change."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
    return files.select("path", F.sha2("content", 256).alias("sha256"))


def fingerprint(spark: SparkSession, base: str, date: str, symbols: list[str], sets: list[str]) -> str:
    """A digest of every file behind a date's features: the driver sees a name and a digest for each."""
    from quaymark.sources import lake

    paths = []
    for name in sets:
        for keys in lake.partitions(spark, base, "silver", name):
            if keys.get("date") == date and keys.get("canonical_symbol") in (None, *symbols):
                inner = "/".join(f"p_{k}={v}" for k, v in keys.items())
                paths.append(f"{base}/silver/{name}/{inner}")
    if not paths:
        return digest([])
    # where a file lies below its dataset counts, its own name does not: a rewrite names files anew
    rows = file_digests(spark, paths).select(F.regexp_extract("path", "/silver/(.*)/[^/]*$", 1).alias("at"), "sha256").collect()
    return digest(f"{r['at']} {r['sha256']}" for r in rows)


def cached(spark: SparkSession, cache: str, name: str, sources: str, builder: str, build: Callable[[], DataFrame],
    refresh: bool = False) -> DataFrame:
    """A frame built once for each digest of its sources and its builder, then read from ``cache``."""
    path = f"{cache}/{name}_{sources}-{builder}.parquet"
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    if refresh or not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _git(*args: str, at: Path | None = None) -> str:
    try:
        return subprocess.run(["git", *args], capture_output=True, text=True, check=True, cwd=at).stdout.strip()
    except (OSError, subprocess.CalledProcessError):
        return ""


def _version(name: str) -> str:
    try:
        return version(name)
    except PackageNotFoundError:
        return ""


def provenance(created_at: str, builder: bytes, columns: Iterable[str], sources: Mapping[str, str],
    packages: Iterable[str] = ("pyspark", "numpy", "pyarrow"), at: Path | None = None) -> dict[str, Any]:
    """What code, columns, sources and packages a run had. The tree is dirty if a tracked file differs from its commit, or an untracked module could have changed what ran."""
    dirty = bool(_git("status", "--porcelain", "--untracked-files=no", at=at)
        or _git("ls-files", "--others", "--exclude-standard", "*.py", at=at))
    return {"created_at": created_at, "git_sha": _git("rev-parse", "--short", "HEAD", at=at), "git_dirty": dirty,
        "builder_fingerprint": digest(builder, 4),
            "feature_schema_digest": digest(columns, 4), "source_fingerprints": dict(sources),
            "packages": {p: _version(p) for p in packages}}


def plain(value: Any) -> Any:
    """A record as JSON can hold it: numbers that are none become null."""
    if isinstance(value, float):
        return value if math.isfinite(value) else None
    if isinstance(value, Mapping):
        return {str(k): plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    if hasattr(value, "item"):
        return plain(value.item())
    return value


def write_run(spark: SparkSession, root: str, record: Mapping[str, Any], oos: DataFrame) -> str:
    """A run as a folder named by its time and commit: the record as JSON, the out-of-sample rows as Parquet, a
    column for each model's prediction. A record without a provenance is an error."""
    stamp = record["provenance"]["created_at"].replace(":", "").replace("-", "")[:15]
    out = f"{root}/{stamp}-{record['provenance']['git_sha'] or 'nogit'}"
    spark.createDataFrame([(json.dumps(plain(record), allow_nan=False, sort_keys=True),)],
        "record string").coalesce(1).write.mode("overwrite").text(f"{out}/record")
    wide(oos).write.mode("overwrite").parquet(f"{out}/oos")
    return out


def read_run(spark: SparkSession, path: str) -> dict[str, Any]:
    return json.loads(spark.read.text(f"{path}/record").first()[0])


def wide(oos: DataFrame) -> DataFrame:
    """``(fold, model, date, ts_ns, y, p)`` with a column ``pred_<model>`` instead of a row for each."""
    models = sorted(r[0] for r in oos.select("model").distinct().collect())
    out = oos.groupBy("fold", "date", "ts_ns", "y").pivot("model", models).agg(F.first("p"))
    return out.select("fold", "date", "ts_ns", "y", *[F.col(f"`{m}`").alias(f"pred_{m}") for m in models])


def tall(frame: DataFrame) -> DataFrame:
    """The inverse of :func:`wide`."""
    models = [c for c in frame.columns if c.startswith("pred_")]
    out = frame.unpivot(["fold", "date", "ts_ns", "y"], models, "model", "p")
    return out.select("fold", F.substring("model", 6, 1000).alias("model"), "date", "ts_ns", "y", "p")


def differences(a: Mapping[str, Any], b: Mapping[str, Any], fields: Iterable[str]) -> list[str]:
    return [f"{f}: {a['spec'].get(f)!r} and {b['spec'].get(f)!r}" for f in fields if a["spec"].get(f) != b["spec"].get(f)]


def check(real: Mapping[str, Any], placebo: Mapping[str, Any] | None = None, reverse: Mapping[str, Any] | None = None,
    allow_dirty: bool = False) -> None:
    """Whether runs may be published side by side; what speaks against it is an error.

    Every run comes from a clean tree. The placebo is the same experiment with the target displaced; the reverse
    is the same but for its direction, which differs; both were built by the same code into the same columns."""
    given = {"real": real, "placebo": placebo, "reverse": reverse}
    for tag, run in given.items():
        if run is not None and run["provenance"]["git_dirty"] and not allow_dirty:
            raise ValueError(f"the {tag} run comes from a dirty tree")
        if run is not None and bool(run["spec"].get("placebo")) != (tag == "placebo"):
            raise ValueError(f"the {tag} run is {'no ' if tag == 'placebo' else 'a '}placebo")
    if reverse is not None and real["spec"].get("predict_venue") == reverse["spec"].get("predict_venue"):
        raise ValueError("neither run reverses the other")
    for tag, run, fields in (("placebo", placebo, EXPERIMENT), ("reverse", reverse, tuple(f for f in EXPERIMENT if f not in DIRECTION))):
        if run is None:
            continue
        if differ := differences(real, run, fields):
            raise ValueError(f"the {tag} run is another experiment: {'; '.join(differ)}")
        for f in ("builder_fingerprint", "feature_schema_digest"):
            if real["provenance"][f] != run["provenance"][f]:
                raise ValueError(f"the {tag} run differs in {f}")


def export(spark: SparkSession, out: str, real: str, placebo: str | None = None, reverse: str | None = None,
    allow_dirty: bool = False) -> list[str]:
    """Check, then copy: the folders written, ``<tag>/record`` and ``<tag>/oos``."""
    paths = {t: p for t, p in (("real", real), ("placebo", placebo), ("reverse", reverse)) if p is not None}
    records = {t: read_run(spark, p) for t, p in paths.items()}
    check(records["real"], records.get("placebo"), records.get("reverse"), allow_dirty)
    written = []
    for tag, p in paths.items():
        spark.read.text(f"{p}/record").coalesce(1).write.mode("overwrite").text(f"{out}/{tag}/record")
        spark.read.parquet(f"{p}/oos").write.mode("overwrite").parquet(f"{out}/{tag}/oos")
        written += [f"{out}/{tag}/record", f"{out}/{tag}/oos"]
    return written


def report(folds: DataFrame, intervals: DataFrame, gaps: Mapping[str, list[str]]) -> list[str]:
    """A run in words: each metric with its interval, its spread over folds, and the columns that were missing."""
    lines = [f"{r['family']:<10}{r['metric']:<16}{_number(r['point'])} [{_number(r['lo'])}, {_number(r['hi'])}]"
        for r in intervals.orderBy("family", "metric").collect()]
    lines += [f"{r['model']:<12}R2 over folds {_number(r['mean'])} +/- {_number(r['std'])}" for r in folds.orderBy("model").collect()]
    return lines + [f"missing in {where}: {', '.join(names)}" for where, names in sorted(gaps.items())]


def _number(x: float | None) -> str:
    return "-" if x is None else f"{x:.5f}"
