"""Watermarked change selection, and keyed upsert of one frame into another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import WATERMARK_DEFAULT, instant


def watermark(target: DataFrame, column: str, default: str = WATERMARK_DEFAULT) -> DataFrame:
    """One row: the newest value of ``column``, or the default for an empty target."""
    like = target.schema[column].dataType
    return target.agg(F.coalesce(F.max(column), instant(default, like)).alias("watermark"))


def changes_since(
    source: DataFrame,
    target: DataFrame | None,
    column: str,
    default: str = WATERMARK_DEFAULT,
) -> DataFrame:
    """Source rows strictly newer than the target's watermark; all rows without a target.

    The watermark stays a scalar subquery, computed once and pushed to the source scan.
    """
    if target is None:
        return source
    return source.where(F.col(column) > watermark(target, column, default).scalar())


def merge_frames(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Target rows whose key did not change, plus the changes (unique by key)."""
    return target.join(changes.select(key), key, "left_anti").unionByName(changes)
