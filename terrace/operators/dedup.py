"""Latest-version deduplication with a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RANK = "_rn"


def latest_version(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The newest row per key; null versions lose, null keys form one group.

    Ties are broken by the remaining columns, so the winner never depends on the order
    in which tasks deliver rows. ``rn = 1`` becomes a group limit on both sides of the
    exchange: each map task forwards one row per key, however hot the key is.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.desc_nulls_last(c) for c in (*newest_first, *tie_breakers)]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def distinct_by_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with no notion of newer: the greatest row in column order wins."""
    first, *rest = [c for c in df.columns if c not in keys] or list(keys)
    return latest_version(df, keys, [first], rest)
