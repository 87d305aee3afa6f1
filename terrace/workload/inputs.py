"""The star-schema tables seen as fleet feeds. Everything is derived in Spark from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.plans.silver import with_types
from terrace.schemas import ORDERS, TELEMETRY
from terrace.session import configure

ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def iso(c: str) -> Column:
    """ISO-8601 text with offset, as the feeds carry it."""
    return F.date_format(F.col(c).cast("timestamp"), ISO)


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as bronze vehicles."""
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("V-"), "s_suppkey").alias("vehicle_id"),
        F.col("s_name").alias("vehicle_type"),
        F.col("s_acctbal").alias("capacity_kg"),
        F.lit("ACTIVE").alias("status"),
    )


def drivers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as bronze drivers; those with a positive balance are available."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("D-"), "c_custkey").alias("driver_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("license_type"),
        F.when(F.col("c_acctbal") > 0, "AVAILABLE").otherwise("OFF_DUTY").alias("status"),
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as bronze telemetry: repeated order lines are versions of one event."""
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("EVT-"), "l_orderkey", F.lit("-"), "l_linenumber").alias("event_id"),
        F.concat(F.lit("V-"), "l_suppkey").alias("vehicle_id"),
        iso("l_shipdate").alias("timestamp"),
        F.col("l_discount").alias("latitude"),
        F.col("l_tax").alias("longitude"),
        F.col("l_returnflag").alias("delivery_status"),
        F.col("l_quantity").alias("cargo_temp_c"),
        F.col("l_extendedprice").alias("speed_kmh"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as bronze orders keyed by customer, so that a key has several versions."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("ORD-"), "o_custkey").alias("order_id"),
        F.col("o_orderpriority").alias("product_name"),
        F.col("o_totalprice").alias("weight_kg"),
        F.col("o_orderkey").alias("destination_lat"),
        F.col("o_custkey").alias("destination_lon"),
        F.col("o_orderstatus").alias("status"),
        iso("o_orderdate").alias("created_at"),
    )


def versioned_telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Telemetry as raw rows whose ingestion time is the ship date."""
    typed = with_types(
        telemetry(spark, sf_dir), floats=TELEMETRY.floats, timestamps=TELEMETRY.timestamps
    )
    return typed.withColumn("ingestion_date", F.col("timestamp"))


def versioned_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw rows whose ingestion time is the order date."""
    typed = with_types(orders(spark, sf_dir), floats=ORDERS.floats, timestamps=ORDERS.timestamps)
    return typed.withColumn("ingestion_date", F.col("created_at"))


def comparable(df: DataFrame) -> DataFrame:
    """Zone-free timestamps and 64-bit floats, the types the checking SQL returns."""
    shown = {}
    for field in df.schema.fields:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            shown[field.name] = F.col(field.name).cast("timestamp_ntz")
        elif kind == "float":
            shown[field.name] = F.col(field.name).cast("double")
    return df.withColumns(shown)
