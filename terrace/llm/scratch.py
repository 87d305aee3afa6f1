"""Written intermediates in the cluster's shared folder, dropped together."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession

from terrace.sources.paths import delete
from terrace.staging import new_folder

# Rows and bytes that Spark hands to a Python function at a time. Its own default of ten
# thousand texts takes tens of MB outside the heap, several times over, and very long texts more.
BATCH_ROWS, BATCH_BYTES = 512, 4 << 20
# Narrow rows of a file, and the tasks that write a small table.
FILE_ROWS = 200_000
LEAST_FILES = 8


_BOUNDS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS,
    "spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES,
}


def bound_batches(spark: SparkSession) -> dict[str, str | None]:
    """Small batches of rows for the Python functions of this session; returns what was set before."""
    before = {key: spark.conf.get(key, None) for key in _BOUNDS}
    for key, value in _BOUNDS.items():
        spark.conf.set(key, value)
    return before


class Scratch:
    """Tables written once and read many times, so that a lost executor costs a re-read and
    not a recomputation. On leaving the block all are deleted but those given to ``result``, and
    the session's batches are as they were."""

    def __init__(self, spark: SparkSession):
        self._before = bound_batches(spark)
        self.spark = spark
        self._folders: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for folder in self._folders:
            delete(self.spark, folder)
        self._folders.clear()
        for key, value in self._before.items():
            if value is None:
                self.spark.conf.unset(key)
            else:
                self.spark.conf.set(key, value)

    def folder(self, label: str) -> str:
        path = new_folder(self.spark, label)
        self._folders.append(path)
        return path

    def keep(self, df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
        """``df``, written and read again; in few files if about ``rows`` narrow rows are known."""
        return _written(_in_files(df, rows), self.folder(label))

    def result(self, df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
        """A table that outlives the block: it belongs to the caller."""
        return _written(_in_files(df, rows), new_folder(self.spark, label))


def _in_files(df: DataFrame, rows: int | None) -> DataFrame:
    if rows is None:
        return df
    return df.coalesce(max(LEAST_FILES, math.ceil(rows / FILE_ROWS)))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
