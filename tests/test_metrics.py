from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from terrace.functions.columns import with_stored_keys
from terrace.operators.snapshots import export_snapshot, read_snapshots
from terrace.plans.metrics import fleet_metrics, temperature_alerts
from tests.helpers import plan

FACTS = "vehicle_id string, event_timestamp timestamp, cargo_temp_c float, delivery_status string"
DIMS = "vehicle_id string, capacity_kg int"


def facts(spark):
    data = [
        ("v-1 ", "2024-01-01", 4.0, "stopped"),
        ("V-1", "2024-01-01", 5.0, " STOPPED"),
        ("V-1", None, 9.0, "DELAYED"),
        ("V-2", "2024-01-01", None, "STOPPED"),
        ("V-3", "2024-01-01", 1.0, "STOPPED"),
        (None, "2024-01-01", 1.0, "STOPPED"),
    ]
    df = spark.createDataFrame(data, "v string, t string, c double, s string")
    return df.select(
        F.col("v").alias("vehicle_id"),
        F.col("t").cast("timestamp").alias("event_timestamp"),
        F.col("c").cast("float").alias("cargo_temp_c"),
        F.col("s").alias("delivery_status"),
    )


def dims(spark):
    return spark.createDataFrame([("V-1", 1500), ("v-2", 3000), ("V-4", 8000)], DIMS)


def listed(df):
    return [tuple(r) for r in df.collect()]


def test_fleet_metrics(spark):
    """Null times are not counted, null temperatures not averaged, unmatched sides drop out."""
    assert listed(fleet_metrics(facts(spark), dims(spark))) == [
        ("V-1", 1500, 2, 6.0),
        ("V-2", 3000, 1, None),
    ]


@pytest.mark.parametrize("status", [" Stopped ", "stopped"])
def test_status_is_normalised(spark, status):
    assert listed(fleet_metrics(facts(spark), dims(spark), status=status)) == [
        ("V-1", 1500, 2, 4.5),
        ("V-2", 3000, 1, None),
    ]


def test_empty_status_means_no_filter(spark):
    assert len(listed(fleet_metrics(facts(spark), dims(spark), status=""))) == 2
    assert listed(fleet_metrics(facts(spark), dims(spark), status="' OR 1=1")) == []


def test_same_as_joining_first(spark):
    """Shrinking the facts before the join must not change counts, means or fan-out."""
    fleet = spark.createDataFrame(
        [("V-1", 1500), (" v-1", 1500), ("V-1", 3000), ("V-2", None), ("V-2", None)], DIMS
    )
    joined = (
        facts(spark)
        .withColumn("k", F.trim(F.upper("vehicle_id")))
        .drop("vehicle_id")
        .join(fleet.withColumn("k", F.trim(F.upper("vehicle_id"))), "k")
        .groupBy(F.col("k").alias("vehicle_id"), "capacity_kg")
        .agg(F.count("event_timestamp"), F.round(F.avg("cargo_temp_c"), 2))
    )
    assert sorted(map(str, listed(fleet_metrics(facts(spark), fleet)))) == sorted(
        map(str, listed(joined))
    )


def test_one_snapshot_does_not_double_the_counts(spark, tmp_path):
    path = str(tmp_path / "s")
    for day in (date(2024, 1, 1), date(2024, 1, 2)):
        export_snapshot(dims(spark), path, day)
    one = read_snapshots(spark, path, as_of=date(2024, 1, 2))
    assert listed(fleet_metrics(facts(spark), one))[0] == ("V-1", 1500, 2, 6.0)
    every = read_snapshots(spark, path, as_of=None)
    assert listed(fleet_metrics(facts(spark), every))[0] == ("V-1", 1500, 4, 6.0)


def test_stored_keys_push_the_filter_to_the_scan(spark, tmp_path):
    plain, keyed = str(tmp_path / "plain"), str(tmp_path / "keyed")
    facts(spark).write.parquet(plain)
    with_stored_keys(facts(spark), "vehicle_id", "delivery_status").write.parquet(keyed)
    computed = fleet_metrics(spark.read.parquet(plain), dims(spark), status="stopped")
    stored = fleet_metrics(spark.read.parquet(keyed), dims(spark), status="stopped")
    assert listed(computed) == listed(stored)
    assert "EqualTo(delivery_status_key,STOPPED)" in plan(stored)
    assert "EqualTo(delivery_status" not in plan(computed)


def test_facts_are_aggregated_before_the_join(spark, tmp_path):
    facts(spark).write.parquet(str(tmp_path / "f"))
    text = plan(fleet_metrics(spark.read.parquet(str(tmp_path / "f")), dims(spark)))
    physical = text[text.index("== Physical Plan ==") :]
    join = next(i for i, line in enumerate(physical.splitlines()) if "Join" in line)
    scan = next(i for i, line in enumerate(physical.splitlines()) if "FileScan parquet" in line)
    between = "\n".join(physical.splitlines()[join:scan])
    assert "partial_count(event_timestamp" in between
    assert "cargo_temp_c" in between and "delivery_status" not in physical


def test_alerts(spark):
    df = spark.createDataFrame(
        [("a", 12.0), ("a", 12.01), ("b", 13.0), ("b", 14.0), ("c", None), ("d", 5.0)],
        "vehicle_id string, cargo_temp_c double",
    )
    assert listed(temperature_alerts(df)) == [("b", 2, 13.5), ("a", 1, 12.01)]
    assert listed(temperature_alerts(df, limit=13.5)) == [("b", 1, 14.0)]


def test_alert_limit_reaches_the_scan(spark, tmp_path):
    facts(spark).write.parquet(str(tmp_path / "f"))
    text = plan(temperature_alerts(spark.read.parquet(str(tmp_path / "f"))))
    assert "GreaterThan(cargo_temp_c,12.0)" in text
    assert "ReadSchema: struct<vehicle_id:string,cargo_temp_c:float>" in text


def test_sort_samples_finished_rows(spark):
    text = plan(temperature_alerts(facts(spark)))
    physical = text[text.index("== Physical Plan ==") :]
    sort, rebalance = physical.index("rangepartitioning"), physical.index("REBALANCE_PARTITIONS")
    assert sort < rebalance < physical.index("HashAggregate")
