"""Staging and mart models as lazy DataFrame functions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import band
from terrace.operators.dedup import latest_version
from terrace.operators.joins import referential_filter
from terrace.operators.quality import TableTests

# Fixed value: only drivers in this state enter the dimension.
DRIVER_AVAILABLE = "AVAILABLE"

# The declared tests of the gold tables.
GOLD_TESTS = {
    "dim_vehicles": TableTests(unique=("vehicle_id",), not_null=("vehicle_id", "capacity_kg")),
    "dim_drivers": TableTests(unique=("driver_id",), not_null=("driver_id",)),
    "fact_telemetry": TableTests(
        unique=("event_id",),
        not_null=("event_id", "vehicle_id"),
        relationships={"vehicle_id": ("dim_vehicles", "vehicle_id")},
    ),
    "fact_orders": TableTests(unique=("order_id",), not_null=("order_id", "destination_lat")),
}


def stg_vehicles(raw_vehicles: DataFrame) -> DataFrame:
    return raw_vehicles.select(
        "vehicle_id",
        "vehicle_type",
        "capacity_kg",
        F.col("status").alias("vehicle_status"),
        "ingestion_date",
    )


def stg_drivers(raw_drivers: DataFrame) -> DataFrame:
    return raw_drivers.select(
        "driver_id",
        F.col("name").alias("driver_name"),
        "license_type",
        F.col("status").alias("driver_status"),
        "ingestion_date",
    )


def latest_telemetry(raw_telemetry: DataFrame) -> DataFrame:
    return latest_version(raw_telemetry, ["event_id"], ["ingestion_date"])


def telemetry_columns(latest: DataFrame) -> DataFrame:
    return latest.select(
        "event_id",
        "vehicle_id",
        F.col("timestamp").alias("event_timestamp"),
        "latitude",
        "longitude",
        "cargo_temp_c",
        "speed_kmh",
        "delivery_status",
        "ingestion_date",
    )


def stg_telemetry(raw_telemetry: DataFrame, raw_vehicles: DataFrame) -> DataFrame:
    """Latest version first, vehicle check second: if the latest version names an unknown
    vehicle the event is left out, it does not fall back to an older version."""
    latest = latest_telemetry(raw_telemetry)
    return telemetry_columns(referential_filter(latest, raw_vehicles, "vehicle_id"))


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    return latest_version(raw_orders, ["order_id"], ["ingestion_date"]).select(
        "order_id",
        "product_name",
        "weight_kg",
        "destination_lat",
        "destination_lon",
        F.col("status").alias("order_status"),
        F.col("created_at").alias("order_created_at"),
        "ingestion_date",
    )


def dim_vehicles(staged: DataFrame) -> DataFrame:
    return staged.select("vehicle_id", "vehicle_type", "capacity_kg", "vehicle_status")


def dim_drivers(staged: DataFrame) -> DataFrame:
    return staged.select("driver_id", "driver_name", "license_type", "driver_status").where(
        F.col("driver_status") == DRIVER_AVAILABLE
    )


def fact_telemetry(staged: DataFrame) -> DataFrame:
    return staged.select(
        "event_id",
        "vehicle_id",
        "event_timestamp",
        "latitude",
        "longitude",
        "cargo_temp_c",
        "speed_kmh",
        band("cargo_temp_c").alias("temperature_alert_status"),
        "delivery_status",
        "ingestion_date",
    )


def fact_orders(staged: DataFrame) -> DataFrame:
    return staged.select(
        "order_id",
        "product_name",
        "weight_kg",
        "destination_lat",
        "destination_lon",
        "order_status",
        "order_created_at",
        "ingestion_date",
    )
