"""Session settings the pipelines rely on."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from threading import Lock
from typing import TypeVar

from pyspark.sql import SparkSession

R = TypeVar("R")

# Of the tables that grow with the feeds; a fifth to a half smaller than Spark's default codec.
TABLE_CODEC = "zstd"

# Settable on a running session. Timestamps without an offset mean UTC; AQE coalesces,
# splits skewed joins and picks broadcasts from measured sizes.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock = Lock()
# Session -> calls that are running, and the setting to go back to.
_running: dict[SparkSession, tuple[int, str | None]] = {}


def drops_shuffles(work: Callable[..., R]) -> Callable[..., R]:
    """While ``work(spark, ...)`` runs, shuffle files leave with the action that wrote them instead of
    when the driver's heap is collected. For work that hands back no DataFrame: a second
    collect of one would have to write its shuffles again."""

    @wraps(work)
    def run(spark: SparkSession, *args, **options) -> R:
        with _lock:
            calls, before = _running.get(spark, (0, None))
            if not calls:
                before = spark.conf.get(_DROP_SHUFFLES, None)
                spark.conf.set(_DROP_SHUFFLES, "true")
            _running[spark] = (calls + 1, before)
        try:
            return work(spark, *args, **options)
        finally:
            with _lock:
                calls, before = _running.pop(spark)
                if calls > 1:
                    _running[spark] = (calls - 1, before)
                elif before is None:
                    spark.conf.unset(_DROP_SHUFFLES)
                else:
                    spark.conf.set(_DROP_SHUFFLES, before)

    return run
