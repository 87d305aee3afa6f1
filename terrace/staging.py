"""Intermediate tables that must be computed once and survive a lost executor.

They are written as Parquet under the shared folder the cluster names in
``spark.checkpoint.dir``, so a re-read prunes columns, carries real sizes for the
broadcast decision and never recomputes its lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from terrace.session import TABLE_CODEC
from terrace.sources.paths import delete

_local_base: str | None = None


def work_base(spark: SparkSession) -> str:
    """The shared scratch folder; only a local-mode session may fall back to its own."""
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="terrace-")
    return _local_base


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{work_base(spark)}/terrace-{label}-{uuid.uuid4().hex}"


@contextmanager
def staged(df: DataFrame, label: str, partition_by: str | None = None) -> Iterator[DataFrame]:
    """Write ``df`` once, hand back the written table, and drop it on leaving the block."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write.option("compression", TABLE_CODEC)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    try:
        writer.parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)
