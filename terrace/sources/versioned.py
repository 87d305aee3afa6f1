"""Tables rebuilt as a whole: each build is a new version folder, readers take the newest
complete one. Nothing that is being read is ever overwritten."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from terrace.sources.paths import children, delete, exists

_PREFIX = "version_"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions, oldest first. Spark writes ``_SUCCESS`` last, so it marks the commit."""
    names = [n for n in children(spark, path) if n.startswith(_PREFIX)]
    return [n for n in names if exists(spark, f"{path}/{n}/_SUCCESS")]


def publish(
    df: DataFrame, path: str, keep: int = 2, protect: str | None = None, keep_seconds: float = 3600
) -> str:
    """Write ``df`` as the newest version and expire what is older than the ``keep`` newest and
    than ``keep_seconds``, for readers that have it open; unfinished leftovers of dead runs go
    at once. A version named by ``protect`` stays."""
    spark = df.sparkSession
    now = time.time_ns()
    version = f"{_PREFIX}{now:020d}_{uuid.uuid4().hex[:8]}"
    df.write.parquet(f"{path}/{version}")
    complete = versions(spark, path)
    expired = f"{_PREFIX}{now - int(keep_seconds * 1e9):020d}"
    kept = {*complete[-keep:], *(v for v in complete if v > expired), protect}
    for name in children(spark, path):
        if name.startswith(_PREFIX) and name < version and name not in kept:
            delete(spark, f"{path}/{name}")
    return version


def read_version(spark: SparkSession, path: str, version: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{version}")


def read_current(spark: SparkSession, path: str) -> DataFrame:
    complete = versions(spark, path)
    if not complete:
        raise FileNotFoundError(f"no complete version below {path}")
    return read_version(spark, path, complete[-1])


def is_published(spark: SparkSession, path: str) -> bool:
    return bool(versions(spark, path))
