"""Independent Spark actions side by side, so that one table's last tasks do not leave the
cluster idle while the next table waits."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

R = TypeVar("R")

# Fixed value: how many tables are built at a time.
WORKERS = 4


def run_together(spark: SparkSession, actions: Iterable[Callable[[], R]]) -> list[R]:
    """Run all to the end, results in order; then the first failure, if any, is raised."""
    with ThreadPoolExecutor(WORKERS) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(action)) for action in actions]
    return [future.result() for future in running]
