"""Cold history: dated increments and dated snapshots, written idempotently."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import within_day
from terrace.schemas import INGESTION_COLUMN
from terrace.session import TABLE_CODEC
from terrace.sources.paths import children, delete

INCREMENT_PARTITION = "ingestion_day"
SNAPSHOT_PARTITION = "snapshot_date"

# Rows that make a file of a history large enough, on average.
_FILE_ROWS = 1 << 18


def _replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    writer = df.write.partitionBy(partition).option("partitionOverwriteMode", "dynamic")
    writer.option("compression", TABLE_CODEC).mode("overwrite").parquet(path)


def write_partitioned(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions present in ``df`` and leave all others alone.

    Rebalancing by the partition column cuts a large day into even files and keeps small
    days to one; a day is never forced through one task.
    """
    _replace_partitions(df.hint("rebalance", partition), path, partition)


def _held(df: DataFrame, partition: str) -> tuple[set, bool]:
    """(partition values with rows, whether the tasks that read ``df`` would write files that are
    large enough). Then a shuffle would move all rows and gain nothing."""
    tasks = df.groupBy(F.spark_partition_id().alias("task"), partition).agg(F.count(F.lit(1)).alias("n"))
    found = tasks.groupBy(partition).agg(F.sum("n"), F.count(F.lit(1))).collect()
    rows, files = sum(r[1] for r in found), sum(r[2] for r in found)
    return {r[0] for r in found}, rows >= files * _FILE_ROWS


def _write_day(df: DataFrame, path: str, partition: str, day: date, stored: bool) -> int:
    """Write one day's rows; an empty day has no partition. Returns the day's stored rows."""
    spark, folder = df.sparkSession, f"{path}/{partition}={day.isoformat()}"
    dated = df.withColumn(partition, F.lit(day.isoformat()))
    if stored:
        held, large = _held(dated, partition)
    else:
        held, large = not df.isEmpty(), False
    if not held:
        delete(spark, folder)
        return 0
    # One partition value only, so the rows are spread evenly instead of by value.
    _replace_partitions(dated if large else dated.hint("rebalance"), path, partition)
    # Counted from the files' footers.
    return spark.read.schema(df.schema).parquet(folder).count()


def export_increment(
    df: DataFrame,
    path: str,
    day: date,
    column: str = INGESTION_COLUMN,
    partition: str = INCREMENT_PARTITION,
    stored: bool = False,
) -> int:
    """Rows of one day by a half-open time range. ``stored`` says that ``df`` reads files, so that
    its rows are cheap to count: where they lie in large pieces they are not shuffled."""
    return _write_day(df.where(within_day(df, column, day)), path, partition, day, stored)


def refresh_increments(
    df: DataFrame,
    path: str,
    days: Collection[date],
    column: str = INGESTION_COLUMN,
    partition: str = INCREMENT_PARTITION,
) -> None:
    """Bring several days of a history in line with the table as it is now.

    One write replaces the days that still hold rows; days that lost their last row go.
    """
    if not days:
        return
    spark = df.sparkSession
    # Ranges, which reach the scan, where a function of the column would not.
    wanted = reduce(or_, [within_day(df, column, day) for day in sorted(days)])
    dated = df.where(wanted).withColumn(partition, F.to_date(column))
    held, large = _held(dated, partition)
    _replace_partitions(dated if large else dated.hint("rebalance", partition), path, partition)
    for day in set(days) - held:
        delete(spark, f"{path}/{partition}={day.isoformat()}")


def export_snapshot(
    df: DataFrame, path: str, day: date, partition: str = SNAPSHOT_PARTITION, stored: bool = False
) -> int:
    """The whole table as it stands, stamped with the day."""
    return _write_day(df, path, partition, day, stored)


def export(
    df: DataFrame, path: str, day: date, column: str = INGESTION_COLUMN, stored: bool = False
) -> int:
    """An increment for tables that know when rows arrived, else a snapshot."""
    if column in df.columns:
        return export_increment(df, path, day, column, stored=stored)
    return export_snapshot(df, path, day, stored=stored)


def read_history(
    spark: SparkSession,
    root: str,
    first_day: date | None = None,
    last_day: date | None = None,
    partition: str = INCREMENT_PARTITION,
) -> DataFrame:
    """All days of a history, or a range of days (other partitions are not read)."""
    df = spark.read.parquet(root)
    if first_day is not None:
        df = df.where(F.col(partition) >= F.lit(first_day))
    if last_day is not None:
        df = df.where(F.col(partition) <= F.lit(last_day))
    return df


def read_snapshots(
    spark: SparkSession,
    root: str,
    as_of: date | None,
    partition: str = SNAPSHOT_PARTITION,
) -> DataFrame:
    """The newest snapshot that is not after ``as_of``; raises if there is none. ``None``
    reads every snapshot, which multiplies joined rows."""
    df = spark.read.parquet(root)
    if as_of is None:
        return df
    folders = [name.partition("=") for name in children(spark, root)]
    taken = [value for name, _, value in folders if name == partition and value <= as_of.isoformat()]
    if not taken:
        raise ValueError(f"{root}: no snapshot of {as_of} or before")
    return df.where(F.col(partition) == F.lit(date.fromisoformat(max(taken))))
