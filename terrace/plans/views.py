"""The models as temporary views, for SQL users. Views are lazy: each query re-plans them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from terrace.layout import Layout
from terrace.plans import models
from terrace.plans.build import gold_tables
from terrace.schemas import DRIVERS, ORDERS, TELEMETRY, VEHICLES
from terrace.sources.versioned import read_current
from terrace.streaming.ingest import read_raw


def staging_models(spark: SparkSession, layout: Layout) -> dict[str, DataFrame]:
    vehicles = read_current(spark, layout.raw(VEHICLES.name))
    telemetry = read_raw(spark, layout.raw(TELEMETRY.name), TELEMETRY)
    return {
        "stg_vehicles": models.stg_vehicles(vehicles),
        "stg_drivers": models.stg_drivers(read_current(spark, layout.raw(DRIVERS.name))),
        "stg_telemetry": models.stg_telemetry(telemetry, vehicles),
        "stg_orders": models.stg_orders(read_raw(spark, layout.raw(ORDERS.name), ORDERS)),
    }


def register_views(spark: SparkSession, layout: Layout) -> list[str]:
    """Register staging and gold under their model names. Register again after a run: a view
    keeps the table version it was created on."""
    views = {**staging_models(spark, layout), **gold_tables(spark, layout)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return list(views)
