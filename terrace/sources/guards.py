"""Empty-input handling. ``isEmpty`` is a take-one job, not a count."""

from __future__ import annotations

from pyspark.sql import DataFrame


class EmptyInputError(ValueError):
    pass


def has_rows(df: DataFrame) -> bool:
    return not df.isEmpty()


def require_rows(df: DataFrame, name: str) -> DataFrame:
    if df.isEmpty():
        raise EmptyInputError(f"{name}: the input holds no records")
    return df
