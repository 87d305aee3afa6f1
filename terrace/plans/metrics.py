"""Metric queries over cold history. They return DataFrames; the caller writes or serialises."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions import exact
from terrace.functions.columns import ALERT_TEMPERATURE, normkey, round_scaled, stored_key


def _ranked(metric: DataFrame, measure: str, *keys: str) -> DataFrame:
    """Sorted by the measure, greatest first, in a total order.

    A global sort samples its input before sorting it. Rebalancing first lets the sample read
    finished rows; otherwise the join and aggregate below would run twice.
    """
    return metric.hint("rebalance").orderBy(F.desc_nulls_last(measure), *keys)


def fleet_metrics(
    facts: DataFrame,
    vehicles: DataFrame,
    status: str | None = None,
    vehicle_column: str = "vehicle_id",
    capacity_column: str = "capacity_kg",
    time_column: str = "event_timestamp",
    temperature_column: str = "cargo_temp_c",
    status_column: str = "delivery_status",
    fact_vehicle_column: str | None = None,
) -> DataFrame:
    """Events and mean temperature per vehicle and capacity, busiest first.

    Facts shrink to one row per vehicle before the join, so neither the fact table nor a
    vehicle with most of the events is ever shuffled row by row. Counts and sums scale
    with the number of matching vehicle rows just as joining first would make them.
    """
    if status:
        facts = facts.where(stored_key(facts, status_column) == normkey(F.lit(status)))
    per_vehicle = facts.groupBy(
        stored_key(facts, fact_vehicle_column or vehicle_column).alias("vehicle_id")
    ).agg(
        F.count(time_column).alias("events"), *exact.sum_parts(F.col(temperature_column), "temp")
    )
    fleet = vehicles.select(
        stored_key(vehicles, vehicle_column).alias("vehicle_id"),
        F.col(capacity_column).alias("capacity_kg"),
    )
    summed = (
        per_vehicle.join(fleet, "vehicle_id")
        .groupBy("vehicle_id", "capacity_kg")
        .agg(F.sum("events").alias("total_telemetry_events"), *exact.summed_parts("temp"))
    )
    metric = summed.select(
        "vehicle_id", "capacity_kg", "total_telemetry_events",
        round_scaled(exact.mean("temp")).alias("avg_cargo_temperature"),
    )
    return _ranked(metric, "total_telemetry_events", "vehicle_id", "capacity_kg")


def temperature_alerts(
    facts: DataFrame,
    limit: float = ALERT_TEMPERATURE,
    vehicle_column: str = "vehicle_id",
    temperature_column: str = "cargo_temp_c",
) -> DataFrame:
    """Readings above the limit per vehicle, most first."""
    metric = (
        facts.where(F.col(temperature_column) > F.lit(limit))
        .groupBy(F.col(vehicle_column).alias("vehicle_id"))
        .agg(F.count(F.lit(1)).alias("total_alerts"), *exact.sum_parts(F.col(temperature_column), "temp"))
        .select("vehicle_id", "total_alerts", round_scaled(exact.mean("temp")).alias("alert_avg_temperature"))
    )
    return _ranked(metric, "total_alerts", "vehicle_id")


def as_records(metric: DataFrame) -> DataFrame:
    """One JSON object per row, for callers that serve or store records as text."""
    return metric.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("record"))
