from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from terrace.plans import models
from terrace.plans.silver import clean_drivers, clean_orders, clean_telemetry, clean_vehicles
from terrace.schemas import ORDERS, TELEMETRY, VEHICLES
from terrace.sources.json_batches import (
    land_daily_snapshot,
    read_json_batches,
    split_corrupt,
    with_source_day,
)
from tests.helpers import (
    driver,
    drivers,
    event,
    order,
    orders,
    plan,
    rows,
    telemetry,
    vehicle,
    vehicles,
)

RUN = datetime(2024, 1, 2, 11)


def test_vehicles_are_typed_stamped_and_distinct(spark):
    df = vehicles(spark, vehicle("V-1", "1500.7"), vehicle("V-1", "1500.7"), vehicle("V-2", "x"))
    cleaned = clean_vehicles(df, RUN)
    assert cleaned.schema == VEHICLES.raw_schema
    shown = cleaned.select("vehicle_id", "capacity_kg", F.col("ingestion_date").cast("string"))
    assert rows(shown) == [
        ("V-1", 1500, "2024-01-02 11:00:00"),
        ("V-2", None, "2024-01-02 11:00:00"),
    ]


def test_null_master_key_survives_once(spark):
    assert clean_vehicles(vehicles(spark, vehicle(None), vehicle(None))).count() == 1
    assert clean_drivers(drivers(spark, driver(None), driver(None), driver("D-1"))).count() == 2


def test_newest_daily_extract_wins(spark, tmp_path):
    prefix = str(tmp_path / "vehicles")
    land_daily_snapshot(vehicles(spark, vehicle("V-1", "9000"), vehicle("V-2")), prefix, date(2024, 1, 1))
    land_daily_snapshot(vehicles(spark, vehicle("V-1", "3000")), prefix, date(2024, 1, 2))
    landed = with_source_day(
        read_json_batches(spark, prefix, VEHICLES.bronze_schema, with_path=True)
    )
    cleaned = clean_vehicles(split_corrupt(landed)[0])
    assert rows(cleaned.select("vehicle_id", "capacity_kg")) == [("V-1", 3000), ("V-2", 1500)]


def test_telemetry_types_and_keys(spark):
    df = telemetry(
        spark,
        event("E-1", "V-1", temp="8.1"),
        event("E-2", "V-1", temp="hot", ts="yesterday"),
        event(None, "V-1"),
        event("E-3", None),
    )
    cleaned = clean_telemetry(df, RUN)
    assert cleaned.schema == TELEMETRY.raw_schema
    shown = cleaned.select(
        "event_id", F.col("timestamp").cast("string"), F.col("cargo_temp_c").cast("string")
    )
    assert rows(shown) == [
        ("E-1", "2024-01-01 10:00:00.123456", "8.1"),
        ("E-2", None, None),
    ]


def test_key_drop_comes_before_dedup(spark):
    """A repeat without a vehicle must not win over the complete row."""
    df = telemetry(spark, event("E-1", "V-1"), event("E-1", None, temp="99"))
    assert rows(clean_telemetry(df).select("event_id", "vehicle_id")) == [("E-1", "V-1")]


def test_orders(spark):
    df = orders(spark, order("O-1"), order("O-1"), order(None), order("O-2", weight="?"))
    cleaned = clean_orders(df, RUN)
    assert cleaned.schema == ORDERS.raw_schema
    assert rows(cleaned.select("order_id", "weight_kg")) == [("O-1", 10.5), ("O-2", None)]


def raw_telemetry(spark, *versions):
    """(hour of ingestion, event record) pairs as raw rows."""
    parts = [clean_telemetry(telemetry(spark, e), datetime(2024, 1, 1, h)) for h, e in versions]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def test_latest_version_naming_an_unknown_vehicle_hides_the_event(spark):
    raw = raw_telemetry(
        spark,
        (1, event("E-1", "V-1")),
        (2, event("E-1", "V-9")),
        (1, event("E-2", "V-9")),
        (2, event("E-2", "V-1")),
    )
    known = clean_vehicles(vehicles(spark, vehicle("V-1")))
    assert rows(models.stg_telemetry(raw, known).select("event_id", "vehicle_id")) == [
        ("E-2", "V-1")
    ]


def test_fact_telemetry_bands(spark):
    temps = {"a": None, "b": "1.99", "c": "2.0", "d": "8.0", "e": "8.01", "f": "NaN"}
    raw = raw_telemetry(spark, *[(1, event(k, "V-1", temp=t)) for k, t in temps.items()])
    known = clean_vehicles(vehicles(spark, vehicle("V-1")))
    fact = models.fact_telemetry(models.stg_telemetry(raw, known))
    assert fact.columns == [
        "event_id",
        "vehicle_id",
        "event_timestamp",
        "latitude",
        "longitude",
        "cargo_temp_c",
        "speed_kmh",
        "temperature_alert_status",
        "delivery_status",
        "ingestion_date",
    ]
    assert dict(rows(fact.select("event_id", "temperature_alert_status"))) == {
        "a": "NORMAL",
        "b": "CRITICAL_LOW",
        "c": "NORMAL",
        "d": "NORMAL",
        "e": "CRITICAL_HIGH",
        "f": "CRITICAL_HIGH",
    }


def test_dimensions(spark):
    raw_vehicles = clean_vehicles(vehicles(spark, vehicle("V-1", status="RETIRED")))
    dim = models.dim_vehicles(models.stg_vehicles(raw_vehicles))
    assert dim.columns == ["vehicle_id", "vehicle_type", "capacity_kg", "vehicle_status"]
    assert rows(dim) == [("V-1", "Van", 1500, "RETIRED")]
    raw_drivers = clean_drivers(drivers(spark, driver("D-1"), driver("D-2", status="AWAY")))
    dim = models.dim_drivers(models.stg_drivers(raw_drivers))
    assert dim.columns == ["driver_id", "driver_name", "license_type", "driver_status"]
    assert rows(dim) == [("D-1", "A Name", "Class A", "AVAILABLE")]


def test_staged_orders_keep_the_newest(spark):
    older = clean_orders(orders(spark, order("O-1", product="Old")), datetime(2024, 1, 1))
    newer = clean_orders(orders(spark, order("O-1", product="New")), datetime(2024, 1, 2))
    staged = models.stg_orders(newer.unionByName(older))
    assert rows(staged.select("order_id", "product_name", "order_status")) == [
        ("O-1", "New", "READY_FOR_DISPATCH")
    ]


def test_views_read_only_the_columns_used(spark, tmp_path):
    path = str(tmp_path / "raw")
    clean_drivers(drivers(spark, driver("D-1"))).write.parquet(path)
    dim = models.dim_drivers(models.stg_drivers(spark.read.parquet(path)))
    text = plan(dim.select("driver_id"))
    assert "ReadSchema: struct<driver_id:string,status:string>" in text
    assert "EqualTo(status,AVAILABLE)" in text
