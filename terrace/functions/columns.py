"""Column helpers: typed casts that turn bad values into NULL, bands, keys and day ranges."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Three separate temperature limits, deliberately not unified.
GATE_TEMPERATURE_LOW = -50.0
GATE_TEMPERATURE_HIGH = 100.0
BAND_TEMPERATURE_HIGH = 8.0
BAND_TEMPERATURE_LOW = 2.0
ALERT_TEMPERATURE = 12.0

# Labels of the temperature band.
BAND_HIGH_LABEL = "CRITICAL_HIGH"
BAND_LOW_LABEL = "CRITICAL_LOW"
BAND_NORMAL_LABEL = "NORMAL"

# Fixed value: the watermark of an empty target.
WATERMARK_DEFAULT = "1900-01-01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_int(c: Column | str) -> Column:
    """NULL for bad text; fractions are cut off, as for a numeric column."""
    return _col(c).try_cast("double").try_cast("int")


def as_float(c: Column | str) -> Column:
    """32-bit float, NULL for bad text."""
    return _col(c).try_cast("float")


def as_timestamp(c: Column | str) -> Column:
    """ISO-8601 text with or without offset, NULL for bad text."""
    return F.try_to_timestamp(_col(c))


def stamp(run_ts: datetime | None = None) -> Column:
    """One ingestion time per query: the clock, or a given instant so that reruns agree."""
    if run_ts is None:
        return F.current_timestamp()
    return F.lit(run_ts.isoformat(sep=" ")).cast("timestamp")


def normkey(c: Column | str) -> Column:
    return F.trim(F.upper(_col(c)))


def stored_key(df: DataFrame, column: str) -> Column:
    """The normalised key: the stored ``<column>_key`` if the table has it, else computed.

    A stored key lets an equality reach the Parquet scan; a function of the column cannot.
    """
    stored = f"{column}_key"
    return F.col(stored) if stored in df.columns else normkey(column)


def with_stored_keys(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({f"{c}_key": normkey(c) for c in columns if c in df.columns})


def band(
    c: Column | str,
    high: float = BAND_TEMPERATURE_HIGH,
    low: float = BAND_TEMPERATURE_LOW,
) -> Column:
    """Strict bounds; NULL falls to the normal label and NaN compares as the greatest value."""
    value = _col(c)
    return (
        F.when(value > F.lit(high), F.lit(BAND_HIGH_LABEL))
        .when(value < F.lit(low), F.lit(BAND_LOW_LABEL))
        .otherwise(F.lit(BAND_NORMAL_LABEL))
    )


def round_scaled(c: Column | str, digits: int = 2) -> Column:
    """Scale, round half away from zero, scale back: the rounding of the metric results.

    ``F.round`` goes by the decimal text instead and differs next to ties: 1.005 becomes
    1.01 there and 1.0 here, 29.044999999999998 becomes 29.04 there and 29.05 here.
    """
    scale = F.lit(float(10**digits))
    return F.round(_col(c) * scale) / scale


def instant(value: date | datetime | str, like: T.DataType) -> Column:
    """A literal of the column's own time type, so the comparison is pushed to the scan."""
    text = value if isinstance(value, str) else value.isoformat()
    return F.lit(text.replace("T", " ")).cast(like)


def within_day(df: DataFrame, column: str, day: date) -> Column:
    """Half-open range [day, day + 1) on a date or timestamp column."""
    like = df.schema[column].dataType
    c = F.col(column)
    return (c >= instant(day, like)) & (c < instant(day + timedelta(days=1), like))


def prior_day(run_date: date) -> date:
    return run_date - timedelta(days=1)


def day_stamp(ts: date | datetime) -> str:
    return ts.strftime("%Y%m%d")


def batch_stamp(ts: datetime) -> str:
    return ts.strftime("%Y%m%d_%H%M%S")
