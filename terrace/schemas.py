"""Explicit schemas and the per-entity cleaning rules.

Bronze columns that silver casts are declared as strings: a malformed number or
timestamp then becomes NULL in the cast instead of spoiling the whole record, and
reading needs no schema-inference job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

CORRUPT_COLUMN = "_corrupt_record"
INGESTION_COLUMN = "ingestion_date"


@dataclass(frozen=True)
class Entity:
    """What silver does to one bronze feed."""

    name: str
    key: str
    columns: tuple[str, ...]
    required: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()
    floats: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()

    @property
    def bronze_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def raw_schema(self) -> T.StructType:
        def kind(column: str) -> T.DataType:
            if column in self.integers:
                return T.IntegerType()
            if column in self.floats:
                return T.FloatType()
            if column in self.timestamps:
                return T.TimestampType()
            return T.StringType()

        fields = [T.StructField(c, kind(c)) for c in self.columns]
        return T.StructType([*fields, T.StructField(INGESTION_COLUMN, T.TimestampType())])


VEHICLES = Entity(
    name="vehicles",
    key="vehicle_id",
    columns=("vehicle_id", "vehicle_type", "capacity_kg", "status"),
    integers=("capacity_kg",),
)

DRIVERS = Entity(
    name="drivers",
    key="driver_id",
    columns=("driver_id", "name", "license_type", "status"),
)

TELEMETRY = Entity(
    name="telemetry",
    key="event_id",
    columns=(
        "event_id",
        "vehicle_id",
        "timestamp",
        "latitude",
        "longitude",
        "delivery_status",
        "cargo_temp_c",
        "speed_kmh",
    ),
    required=("event_id", "vehicle_id"),
    floats=("latitude", "longitude", "cargo_temp_c", "speed_kmh"),
    timestamps=("timestamp",),
)

ORDERS = Entity(
    name="orders",
    key="order_id",
    columns=(
        "order_id",
        "product_name",
        "weight_kg",
        "destination_lat",
        "destination_lon",
        "status",
        "created_at",
    ),
    required=("order_id",),
    floats=("weight_kg", "destination_lat", "destination_lon"),
    timestamps=("created_at",),
)

MASTERS = (VEHICLES, DRIVERS)
FEEDS = (TELEMETRY, ORDERS)
