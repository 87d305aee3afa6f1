"""The bronze telemetry gate and the gold test suite."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions.columns import GATE_TEMPERATURE_HIGH, GATE_TEMPERATURE_LOW
from terrace.layout import Layout
from terrace.operators.quality import (
    expect_between,
    expect_not_null,
    expect_null,
    gate,
    run_tests,
)
from terrace.plans import fact_tests
from terrace.plans.build import fact_table
from terrace.plans.models import GOLD_TESTS
from terrace.schemas import CORRUPT_COLUMN, TELEMETRY
from terrace.sources.json_batches import read_json_batches, with_corrupt_column
from terrace.sources.paths import exists, files_below, make_folder
from terrace.sources.versioned import is_published

JUDGED = ("latitude", "longitude", "cargo_temp_c")
# Null where the text is a number or missing.
UNREADABLE_TEMPERATURE = "unreadable_cargo_temp_c"

_LIST_SCHEMA = "path string"

TELEMETRY_EXPECTATIONS = (
    expect_not_null("latitude"),
    expect_not_null("longitude"),
    expect_between("cargo_temp_c", GATE_TEMPERATURE_LOW, GATE_TEMPERATURE_HIGH),
    expect_null(UNREADABLE_TEMPERATURE),
)


def judged(bronze: DataFrame) -> DataFrame:
    """Bronze telemetry as the gate judges it: 64-bit numbers, and the text that is none."""
    text = F.col("cargo_temp_c").cast("string")
    unreadable = F.when(text.try_cast("double").isNull(), text)
    doubles = {c: F.col(c).try_cast("double") for c in JUDGED}
    return bronze.withColumn(UNREADABLE_TEMPERATURE, unreadable).withColumns(doubles)


def telemetry_gate(bronze: DataFrame, max_corrupt: int = 0) -> list[dict]:
    """Judge bronze telemetry in one pass; raises on any violation and on more than
    ``max_corrupt`` records that do not parse, passes empty input. Unparsed records are
    counted but their missing values are not."""
    if CORRUPT_COLUMN not in bronze.columns:
        return gate(judged(bronze), TELEMETRY_EXPECTATIONS, TELEMETRY.name)
    parsed = [e.where(F.col(CORRUPT_COLUMN).isNull) for e in TELEMETRY_EXPECTATIONS]
    checks = [*parsed, expect_null(CORRUPT_COLUMN, at_most=max_corrupt)]
    return gate(judged(bronze), checks, TELEMETRY.name)


def gate_bronze(spark: SparkSession, layout: Layout, max_corrupt: int = 0) -> list[dict]:
    """Gate all landed files, admitted or not."""
    return _judge(spark, layout, _landed(spark, layout), max_corrupt)


def admitted_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """The names of all files ever admitted (``path``)."""
    return spark.read.schema(_LIST_SCHEMA).parquet(_lists(spark, layout))


def gate_and_admit(
    spark: SparkSession, layout: Layout, full: bool = False, max_corrupt: int = 0
) -> list[dict]:
    """Judge the landed files that are not admitted yet, by name, and admit exactly these: their
    names are published in one write, and no file is moved.

    Ingestion takes the files of published lists only, so what landed after the listing waits for
    the next run, and a failing file stays in scope until it is gone. ``full`` judges admitted files
    that are still there again as well.
    """
    landed = _landed(spark, layout)
    names = spark.createDataFrame([(f,) for f in landed], _LIST_SCHEMA)
    fresh = names.join(admitted_files(spark, layout), "path", "left_anti")
    new = [row["path"] for row in fresh.collect()]
    report = _judge(spark, layout, landed if full else new, max_corrupt)
    if new:
        # A list holds as many files as a run may take at a time.
        at_most = layout.max_files_per_trigger or 0
        listed = spark.createDataFrame([(f,) for f in sorted(new)], _LIST_SCHEMA).coalesce(1)
        listed.write.mode("append").option("maxRecordsPerFile", at_most).parquet(_lists(spark, layout))
    return report


def _lists(spark: SparkSession, layout: Layout) -> str:
    path = layout.admitted(TELEMETRY.name)
    make_folder(spark, path)
    return path


def _landed(spark: SparkSession, layout: Layout) -> list[str]:
    return files_below(spark, layout.bronze(TELEMETRY.name))


def _judge(spark: SparkSession, layout: Layout, files: list[str], max_corrupt: int) -> list[dict]:
    # With nothing to judge the folder itself must at least be there.
    if not files:
        if not exists(spark, layout.bronze(TELEMETRY.name)):
            raise FileNotFoundError(f"no folder {layout.bronze(TELEMETRY.name)}")
        full = with_corrupt_column(TELEMETRY.bronze_schema)
        return telemetry_gate(spark.createDataFrame([], full), max_corrupt)
    return telemetry_gate(read_json_batches(spark, files, TELEMETRY.bronze_schema), max_corrupt)


def gold_tests(tables: Mapping[str, DataFrame]) -> DataFrame:
    return run_tests(tables, GOLD_TESTS)


def gold_tests_by_change(spark: SparkSession, layout: Layout, dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """The same tests: dimensions as a whole, facts by what is known of their rows since the rows
    last changed."""
    tests = {name: declared for name, declared in GOLD_TESTS.items() if name in dimensions}
    parts = [run_tests(dimensions, tests)]
    for name, declared in GOLD_TESTS.items():
        if name not in dimensions and is_published(spark, layout.state(f"{name}_tested")):
            parts.append(fact_tests.results(spark, layout, name, declared, dict(dimensions)))
        elif name not in dimensions:
            # A fact that never held a row.
            empty = {name: fact_table(spark, layout, name).read(), **dimensions}
            parts.append(run_tests(empty, {name: declared}))
    return reduce(DataFrame.unionByName, parts)
