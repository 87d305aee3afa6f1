"""Expectations on rows, tests on tables, and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.joins import orphan_counts


class QualityGateError(ValueError):
    def __init__(self, message: str, report: list[dict]):
        super().__init__(message)
        self.report = report


# --- row expectations -------------------------------------------------------------


@dataclass(frozen=True)
class Expectation:
    check: str
    column: str
    # Called when a plan is built, so expectations can be declared without a session.
    violated: Callable[[], Column]
    # Violations that still pass.
    at_most: int = 0

    def where(self, condition: Callable[[], Column]) -> Expectation:
        """The same expectation, of the rows that meet the condition only."""
        return replace(self, violated=lambda: condition() & self.violated())


def expect_null(column: str, at_most: int = 0) -> Expectation:
    return Expectation("null", column, lambda: F.col(column).isNotNull(), at_most)


def expect_not_null(column: str) -> Expectation:
    return Expectation("not_null", column, lambda: F.col(column).isNull())


def expect_between(column: str, low: float, high: float) -> Expectation:
    """Inclusive bounds; NULL is not judged, NaN is out of range."""
    return Expectation("between", column, lambda: ~F.col(column).between(low, high))


def evaluate(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """One row per expectation, all counted in a single pass over ``df``."""
    tallies = [F.count_if(e.violated()).alias(f"u{i}") for i, e in enumerate(expectations)]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *tallies)
    reports = [
        F.struct(
            F.lit(e.check).alias("check"),
            F.lit(e.column).alias("column"),
            F.col("rows").alias("evaluated"),
            F.col(f"u{i}").alias("unexpected"),
            (F.col(f"u{i}") <= e.at_most).alias("passed"),
        )
        for i, e in enumerate(expectations)
    ]
    return counted.select(F.inline(F.array(*reports)))


def gate(df: DataFrame, expectations: Sequence[Expectation], name: str) -> list[dict]:
    """Raise if any expectation fails. Empty input passes. Returns the report rows."""
    report = [row.asDict() for row in evaluate(df, expectations).collect()]
    failed = [r for r in report if not r["passed"]]
    if failed:
        detail = ", ".join(f"{r['check']}({r['column']}): {r['unexpected']}" for r in failed)
        raise QualityGateError(f"{name}: quality gate failed: {detail}", report)
    return report


# --- table tests --------------------------------------------------------------------


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table."""

    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    # column -> (parent table, parent column)
    relationships: Mapping[str, tuple[str, str]] | None = None


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Non-null keys that occur more than once, with their count."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def test_result(table: str, column: str, test: str, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table"),
        F.lit(column).alias("column"),
        F.lit(test).alias("test"),
        failures.cast("long").alias("failures"),
        (failures == 0).alias("passed"),
    )


def _key_and_null_tests(table: str, df: DataFrame, key: str, not_null: Sequence[str]) -> DataFrame:
    """Uniqueness of ``key`` and every null count from one scan and one key shuffle.

    Null counts ride along as partial sums, so a hot key shrinks to a row per map task.
    """
    nulls = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(not_null)]
    per_key = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("n"), *nulls)
    total = per_key.agg(
        F.count_if(F.col("_key").isNotNull() & (F.col("n") > 1)).alias("dup"),
        *[F.coalesce(F.sum(f"n{i}"), F.lit(0)).alias(f"n{i}") for i in range(len(not_null))],
    )
    rows = [
        test_result(table, key, "unique", F.col("dup")),
        *[test_result(table, c, "not_null", F.col(f"n{i}")) for i, c in enumerate(not_null)],
    ]
    return total.select(F.inline(F.array(*rows)))


def _null_tests(table: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    total = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    rows = [test_result(table, c, "not_null", F.col(f"n{i}")) for i, c in enumerate(columns)]
    return total.select(F.inline(F.array(*rows)))


def _relationship_test(
    table: str, df: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    total = orphan_counts(df, parent, column, parent_column).agg(
        F.coalesce(F.sum("orphans"), F.lit(0)).alias("orphans")
    )
    row = test_result(table, column, "relationships", F.col("orphans"))
    return total.select(F.inline(F.array(row)))


def run_tests(tables: Mapping[str, DataFrame], tests: Mapping[str, TableTests]) -> DataFrame:
    """One result row per declared test: table, column, test, failures, passed."""
    parts: list[DataFrame] = []
    for name, declared in tests.items():
        df = tables[name]
        if declared.unique:
            first, *others = declared.unique
            parts.append(_key_and_null_tests(name, df, first, declared.not_null))
            parts += [_key_and_null_tests(name, df, key, ()) for key in others]
        elif declared.not_null:
            parts.append(_null_tests(name, df, declared.not_null))
        for column, (parent, parent_column) in (declared.relationships or {}).items():
            parts.append(_relationship_test(name, df, column, tables[parent], parent_column))
    return reduce(DataFrame.unionByName, parts)


def require_passed(results: DataFrame) -> list[dict]:
    """Raise if any declared test failed; the report holds one row per test."""
    report = [row.asDict() for row in results.collect()]
    failed = [r for r in report if not r["passed"]]
    if failed:
        detail = ", ".join(
            f"{r['test']}({r['table']}.{r['column']}): {r['failures']}" for r in failed
        )
        raise QualityGateError(f"table tests failed: {detail}", report)
    return report
