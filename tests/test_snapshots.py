from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from terrace.operators import snapshots
from terrace.operators.snapshots import (
    export,
    export_increment,
    read_history,
    read_snapshots,
    refresh_increments,
    write_partitioned,
)
from tests.helpers import plan, rows

DAY, NEXT = date(2024, 1, 15), date(2024, 1, 16)


def arrivals(spark, *records):
    df = spark.createDataFrame(list(records), "id string, at string")
    return df.select("id", F.col("at").cast("timestamp").alias("ingestion_date"))


def test_increment_takes_the_whole_day(spark, tmp_path):
    df = arrivals(
        spark,
        ("before", "2024-01-14 23:59:59.999999"),
        ("midnight", "2024-01-15 00:00:00"),
        ("morning", "2024-01-15 10:00:00"),
        ("last", "2024-01-15 23:59:59.999999"),
        ("after", "2024-01-16 00:00:00"),
    )
    path = str(tmp_path / "h")
    assert export(df, path, DAY) == 3
    history = read_history(spark, path)
    assert sorted(r["id"] for r in history.collect()) == ["last", "midnight", "morning"]
    assert history.select("ingestion_day").distinct().first()[0] == DAY


def test_repeated_export_replaces_its_day_only(spark, tmp_path):
    path = str(tmp_path / "h")
    df = arrivals(spark, ("a", "2024-01-15 10:00:00"), ("b", "2024-01-16 10:00:00"))
    for day in (DAY, NEXT, DAY):
        assert export_increment(df, path, day) == 1
    assert sorted(r["id"] for r in read_history(spark, path).collect()) == ["a", "b"]
    late = arrivals(spark, ("a", "2024-01-15 10:00:00"), ("late", "2024-01-15 11:00:00"))
    assert export_increment(late, path, DAY) == 2
    assert sorted(r["id"] for r in read_history(spark, path).collect()) == ["a", "b", "late"]


def test_day_without_rows_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "h")
    df = arrivals(spark, ("a", "2024-01-15 10:00:00"))
    assert export(df, path, NEXT) == 0
    assert export(df, path, DAY) == 1
    assert export(df, path, NEXT) == 0
    assert read_history(spark, path).count() == 1


def test_tables_without_arrival_time_become_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    assert export(spark.createDataFrame([("v", 1)], "id string, n int"), path, DAY) == 1
    assert export(spark.createDataFrame([("v", 2)], "id string, n int"), path, NEXT) == 1
    assert rows(read_snapshots(spark, path, as_of=DAY)) == [("v", 1, DAY)]
    assert read_snapshots(spark, path, as_of=None).count() == 2


def test_other_partitions_are_not_read(spark, tmp_path):
    path = str(tmp_path / "s")
    for day in (DAY, NEXT):
        export(spark.createDataFrame([("v", 1)], "id string, n int"), path, day)
    text = plan(read_snapshots(spark, path, as_of=DAY))
    assert "(snapshot_date#" in text.split("PartitionFilters: [")[1].split("]")[0]
    hist = str(tmp_path / "h")
    export_increment(arrivals(spark, ("a", "2024-01-15 10:00:00")), hist, DAY)
    ranged = plan(read_history(spark, hist, DAY, NEXT))
    assert "(ingestion_day#" in ranged.split("PartitionFilters: [")[1].split("]")[0]


def test_large_partition_is_written_by_several_tasks(spark, tmp_path):
    """A partition value with most of the rows is cut into even files."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "200KB")
    try:
        df = spark.range(0, 100_000, 1, 8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
            F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("p"),
        )
        write_partitioned(df, str(tmp_path / "t"), "p")
    finally:
        spark.conf.set(key, before)
    assert len(list((tmp_path / "t" / "p=hot").glob("*.parquet"))) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100_000


def test_stored_days_in_large_pieces_are_written_where_they_are_read(spark, tmp_path, monkeypatch):
    """Four files of 100 rows, half of them of each day: with 50 rows a file and day enough,
    each is written by the task that read it; with 51 they are gathered."""
    at = F.when(F.col("id") % 2 == 0, "2024-01-15 10:00:00").otherwise("2024-01-16 10:00:00")
    table = spark.range(0, 400, 1, 4).select("id", at.cast("timestamp").alias("ingestion_date"))
    for enough, files in ((50, 4), (51, 1)):
        monkeypatch.setattr(snapshots, "_FILE_ROWS", enough)
        path = str(tmp_path / str(enough))
        assert export(table, path, DAY, stored=True) == 200
        assert len(list((tmp_path / str(enough) / "ingestion_day=2024-01-15").glob("*.parquet"))) == files
        refresh_increments(table, path, [DAY, NEXT])
        for day in ("2024-01-15", "2024-01-16"):
            assert len(list((tmp_path / str(enough) / f"ingestion_day={day}").glob("*.parquet"))) == files
        history = read_history(spark, path)
        assert rows(history.select("id", "ingestion_date")) == rows(table)
        assert history.where(F.to_date("ingestion_date") != F.col("ingestion_day")).count() == 0
        refresh_increments(table.where("id % 2 = 0"), path, [DAY, NEXT])
        assert read_history(spark, path).count() == 200 == read_history(spark, path, DAY, DAY).count()
        assert export(table.where("id < 0"), path, DAY, stored=True) == 0
