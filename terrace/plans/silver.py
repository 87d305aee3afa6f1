"""Silver: typed, stamped, key-checked records."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from terrace.functions.columns import as_float, as_int, as_timestamp, stamp
from terrace.operators.dedup import distinct_by_key, latest_version
from terrace.schemas import DRIVERS, INGESTION_COLUMN, ORDERS, TELEMETRY, VEHICLES, Entity
from terrace.sources.json_batches import SOURCE_DAY_COLUMN


def with_types(
    df: DataFrame,
    integers: Sequence[str] = (),
    floats: Sequence[str] = (),
    timestamps: Sequence[str] = (),
) -> DataFrame:
    """Cast columns in place; values that do not convert become NULL."""
    return df.withColumns(
        {
            **{c: as_int(c) for c in integers},
            **{c: as_float(c) for c in floats},
            **{c: as_timestamp(c) for c in timestamps},
        }
    )


def typed_and_stamped(df: DataFrame, entity: Entity, run_ts: datetime | None = None) -> DataFrame:
    typed = with_types(df, entity.integers, entity.floats, entity.timestamps)
    return typed.withColumn(INGESTION_COLUMN, stamp(run_ts))


def clean(df: DataFrame, entity: Entity, run_ts: datetime | None = None) -> DataFrame:
    """Type, stamp, drop rows without their keys, keep one row per key.

    Where the source day is known, the newest day's row wins.
    """
    rows = typed_and_stamped(df, entity, run_ts)
    if entity.required:
        rows = rows.dropna(subset=list(entity.required))
    if SOURCE_DAY_COLUMN in rows.columns:
        rows = latest_version(rows, [entity.key], [SOURCE_DAY_COLUMN])
    else:
        rows = distinct_by_key(rows, [entity.key])
    return rows.select(*entity.columns, INGESTION_COLUMN)


def clean_vehicles(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return clean(df, VEHICLES, run_ts)


def clean_drivers(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return clean(df, DRIVERS, run_ts)


def clean_telemetry(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return clean(df, TELEMETRY, run_ts)


def clean_orders(df: DataFrame, run_ts: datetime | None = None) -> DataFrame:
    return clean(df, ORDERS, run_ts)
