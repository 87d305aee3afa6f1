from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators.joins import (
    flag_known,
    join_on_normalised_key,
    orphan_counts,
    orphans,
    referential_filter,
)
from tests.helpers import executed_plan, plan, rows


def child(spark):
    return spark.createDataFrame([("1", "p"), ("2", "p"), ("3", "q"), ("4", None)], "id string, k string")


def test_semi_join_adds_neither_rows_nor_columns(spark):
    parent = spark.createDataFrame([("p", 1), ("p", 2)], "k string, x int")
    kept = referential_filter(child(spark), parent, "k")
    assert kept.columns == ["id", "k"]
    assert sorted(r["id"] for r in kept.collect()) == ["1", "2"]


def test_parent_key_may_have_another_name(spark):
    parent = spark.createDataFrame([("q",)], "pk string")
    assert [r["id"] for r in referential_filter(child(spark), parent, "k", "pk").collect()] == ["3"]


def test_orphans_ignore_null_keys(spark):
    parent = spark.createDataFrame([("p",)], "k string")
    assert [r["id"] for r in orphans(child(spark), parent, "k").collect()] == ["3"]
    assert rows(orphan_counts(child(spark), parent, "k")) == [("q", 1)]


def test_flag_known_keeps_every_row_once(spark):
    parent = spark.createDataFrame([("p",), ("p",)], "k string")
    flagged = flag_known(child(spark), parent, "k", "known").select("id", "known")
    assert rows(flagged) == [("1", True), ("2", True), ("3", False), ("4", False)]


def test_normalised_join_fans_out_over_snapshots(spark):
    left = spark.createDataFrame([(" v-1", 1)], "vehicle string, n int")
    right = spark.createDataFrame([("V-1 ", "d1"), ("v-1", "d2")], "vehicle_id string, day string")
    joined = join_on_normalised_key(left, right, "vehicle", "vehicle_id")
    assert sorted(r["day"] for r in joined.collect()) == ["d1", "d2"]


def test_small_parent_is_broadcast_large_one_is_not(spark, tmp_path):
    spark.createDataFrame([("p",)], "k string").write.parquet(str(tmp_path / "small"))
    small = spark.read.parquet(str(tmp_path / "small"))
    assert "BroadcastHashJoin" in executed_plan(referential_filter(child(spark), small, "k"))
    large = spark.range(10_000_000).select(F.col("id").cast("string").alias("k"))
    assert "SortMergeJoin" in plan(referential_filter(child(spark), large, "k"))


def test_hot_key_partition_is_split(spark):
    """A third of the rows share one key and the parent is too large to broadcast."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        facts = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        parent = spark.range(0, 300_000, 1, 8).select(F.col("id").alias("k"))
        kept = referential_filter(facts, parent, "k")
        counted = kept.agg(F.count("payload"))
        assert counted.first()[0] == 300_000
        assert "skew=true" in executed_plan(counted)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
