"""The log of days whose stored rows changed, by which the backup brings history in line.

A run appends its days before it commits the fact, so a run that dies at any point has lost none.
Each entry names the commit it was written for. The backup consumes exactly the entries whose
commit the fact had reached before it was read: what a run logs meanwhile waits for the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

from terrace.layout import Layout
from terrace.sources.paths import children, delete, exists


@dataclass(frozen=True)
class Entry:
    fact: str
    commit: int
    path: str


def _root(layout: Layout, fact: str) -> str:
    return layout.state(f"{fact}_changed_days")


def append(spark: SparkSession, layout: Layout, fact: str, days: Collection[date], commit: int) -> None:
    if days:
        rows = spark.createDataFrame([(day,) for day in sorted(days)], "day date").coalesce(1)
        rows.write.parquet(f"{_root(layout, fact)}/{commit:012d}-{uuid.uuid4().hex}")


def entries(spark: SparkSession, layout: Layout, fact: str) -> list[Entry]:
    root = _root(layout, fact)
    names = [n for n in children(spark, root) if exists(spark, f"{root}/{n}/_SUCCESS")]
    return [Entry(fact, int(n.split("-")[0]), f"{root}/{n}") for n in names]


def days_of(spark: SparkSession, logged: Collection[Entry]) -> list[date]:
    """Distinct days: dates, never rows."""
    if not logged:
        return []
    found = spark.read.schema("day date").parquet(*[e.path for e in logged])
    return sorted(r["day"] for r in found.distinct().collect())


def consume(spark: SparkSession, logged: Collection[Entry], reached: Mapping[str, int]) -> None:
    for entry in logged:
        if entry.commit <= reached[entry.fact]:
            delete(spark, entry.path)
