"""Referential joins. Join strategy is left to measured sizes: a small parent is broadcast,
a large one is shuffled and a hot key's partition is split by adaptive execution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import stored_key


def _keys_of(parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    return parent.select(F.col(parent_key).alias(name))


def referential_filter(
    df: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Rows whose key exists in the parent. A semi-join: the parent adds neither rows nor columns."""
    known = _keys_of(parent, parent_key or key, key)
    return df.join(known, key, "left_semi").select(*df.columns)


def flag_known(
    df: DataFrame,
    parent: DataFrame,
    key: str,
    flag: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Every row, with a column telling whether its key exists in the parent."""
    known = _keys_of(parent, parent_key or key, key).distinct().withColumn(flag, F.lit(True))
    flagged = df.join(known, key, "left")
    return flagged.select(*df.columns, F.coalesce(flag, F.lit(False)).alias(flag))


def orphans(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Rows with a non-null key that the parent lacks."""
    known = _keys_of(parent, parent_key or key, key)
    keyed = child.where(F.col(key).isNotNull())
    return keyed.join(known, key, "left_anti").select(*child.columns)


def orphan_counts(
    child: DataFrame,
    parent: DataFrame,
    key: str,
    parent_key: str | None = None,
) -> DataFrame:
    """Orphans per key. Counting first leaves one row per key for the anti-join to move."""
    counted = (
        child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("orphans"))
    )
    return counted.join(_keys_of(parent, parent_key or key, key), key, "left_anti")


def join_on_normalised_key(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    how: str = "inner",
) -> DataFrame:
    """Equi-join on trimmed upper-case keys; both sides keep their columns."""
    name = "_join_key"
    keyed_left = left.withColumn(name, stored_key(left, left_key))
    keyed_right = right.withColumn(name, stored_key(right, right_key))
    return keyed_left.join(keyed_right, name, how).drop(name)
