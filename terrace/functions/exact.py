"""Sums and means of doubles that do not depend on the order of the rows.

A double is cut into two whole numbers, multiples of 2^-20 and of 2^-72, and these are summed
exactly. Values of 2^-20 and more lose nothing in that; smaller ones are cut at 2^-72, each by
itself, so sums still agree however files are cut and tasks scheduled. Values of 2^42 and more,
infinite ones and NaN are summed as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_HIGH, _LOW, _GREATEST = 2.0**20, 2.0**52, 2.0**42
_PARTS = ("high", "low", "other", "count")


def sum_parts(value: Column, name: str) -> list[Column]:
    """Aggregates ``<name>_high``, ``_low``, ``_other`` and ``_count``."""
    x = value.cast("double")
    cut = F.abs(x) < _GREATEST
    scaled = F.when(cut, x) * _HIGH
    high = scaled.cast("long")
    low = ((scaled - high.cast("double")) * _LOW).cast("long")
    sums = (
        F.sum(high.cast("decimal(19,0)")),
        F.sum(low.cast("decimal(19,0)")),
        F.sum(F.when(~cut, x)),
        F.count(x),
    )
    return [s.alias(f"{name}_{part}") for s, part in zip(sums, _PARTS, strict=True)]


def summed_parts(name: str) -> list[Column]:
    """The aggregates again, over rows that hold parts."""
    return [F.sum(f"{name}_{part}").alias(f"{name}_{part}") for part in _PARTS]


def total(name: str) -> Column:
    """The sum that the parts stand for; null without values."""
    high, low, other, count = (F.col(f"{name}_{part}") for part in _PARTS)
    whole = F.coalesce(high.cast("double"), F.lit(0.0)) / _HIGH
    rest = F.coalesce(low.cast("double"), F.lit(0.0)) / (_HIGH * _LOW)
    return F.when(count > 0, whole + rest + F.coalesce(other, F.lit(0.0)))


def mean(name: str) -> Column:
    return F.try_divide(total(name), F.col(f"{name}_count"))
