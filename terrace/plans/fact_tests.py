"""The declared tests of the facts, kept up to date by the rows that change.

What the tests need to know of a fact is small next to it: the keys that occur twice, the keys of rows
with a null where none may be, and how many rows name each parent. A run takes the keys it upserted
out of that and puts the arriving rows' in; counts by parent lose the replaced rows and gain the
arriving ones. Uniqueness is looked up for the arriving keys only, through the key index: other keys
were unique before and did not change.

The state names the commit of the fact that it describes. If that is not the commit the run built
on, after a run that died between the two or for a new test, the whole fact is read again.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.layout import Layout
from terrace.operators.keyed_table import KeyedTable, Upserted
from terrace.operators.quality import TableTests, test_result
from terrace.sources.versioned import is_published, publish, read_current

_UNIQUE, _NULL, _PARENT, _COMMIT = "unique", "null", "parent", "commit"
_COLUMNS = ("kind", "item", "key", "n")


def _path(layout: Layout, fact: str) -> str:
    return layout.state(f"{fact}_tested")


def _read(spark: SparkSession, layout: Layout, fact: str, commit: int) -> DataFrame | None:
    """The state, if it describes this commit."""
    if not is_published(spark, _path(layout, fact)):
        return None
    rows = read_current(spark, _path(layout, fact))
    mark = rows.where(F.col("kind") == _COMMIT).first()
    return rows if mark is not None and mark["n"] == commit else None


def _row(kind: str, item: str, key, n) -> list:
    return [F.lit(kind).alias("kind"), F.lit(item).alias("item"), key.cast("string").alias("key"), n.cast("long").alias("n")]


def _nulls(rows: DataFrame, key: str, declared: TableTests) -> list[DataFrame]:
    return [
        rows.where(F.col(c).isNull()).select(*_row(_NULL, c, F.col(key), F.lit(1)))
        for c in declared.not_null
        if c != key
    ]


def _twice(rows: DataFrame, key: str) -> DataFrame:
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return counted.select(*_row(_UNIQUE, key, F.col(key), F.col("n")))


def _parents(rows: DataFrame, declared: TableTests, sign: int) -> list[DataFrame]:
    return [
        rows.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
        .select(*_row(_PARENT, c, F.col(c), F.col("n") * sign))
        for c in (declared.relationships or {})
    ]


def update(
    spark: SparkSession, layout: Layout, fact: str, table: KeyedTable, declared: TableTests,
    incoming: DataFrame | None, done: Upserted | None,
) -> None:
    """Bring the state in line with the table after an upsert of ``incoming``; without them the
    whole table is read."""
    state = None if done is None else _read(spark, layout, fact, done.before)
    if done is not None and done.version is None and state is not None:
        return
    key = table.key
    if state is None or incoming is None:
        rows = table.read()
        parts = [_twice(rows, key), *_nulls(rows, key, declared)]
        parents = _parents(rows, declared, 1)
    else:
        keys = incoming.select(key)
        untouched = state.where(F.col("kind").isin(_UNIQUE, _NULL))
        untouched = untouched.join(keys.select(F.col(key).cast("string").alias("key")), "key", "left_anti")
        found = _twice(table.lookup(keys).select(key), key)
        parts = [untouched.select(*_COLUMNS), found, *_nulls(incoming, key, declared)]
        parents = [state.where(F.col("kind") == _PARENT).select(*_COLUMNS), *_parents(incoming, declared, 1)]
        replaced = table.replaced(done.version) if done.version else None
        if replaced is not None:
            parents += _parents(replaced, declared, -1)
    if parents:
        counts = reduce(DataFrame.unionByName, parents).groupBy("kind", "item", "key").agg(F.sum("n").alias("n"))
        parts.append(counts.where("n <> 0").select(*_COLUMNS))
    commit = table.commit_number() if done is None else done.after
    mark = spark.range(1).select(*_row(_COMMIT, "", F.lit(None), F.lit(commit)))
    publish(reduce(DataFrame.unionByName, [*parts, mark]), _path(layout, fact))


def results(
    spark: SparkSession, layout: Layout, fact: str, declared: TableTests, parents: dict[str, DataFrame]
) -> DataFrame:
    """One result row per declared test of the fact, from the state alone."""
    state = read_current(spark, _path(layout, fact))

    def failures(kind: str, item: str) -> DataFrame:
        rows = state.where((F.col("kind") == kind) & (F.col("item") == item))
        return rows.agg(F.count(F.lit(1)).alias("failures"))

    parts = [failures(_UNIQUE, c).select(F.inline(F.array(test_result(fact, c, "unique", F.col("failures"))))) for c in declared.unique]
    parts += [failures(_NULL, c).select(F.inline(F.array(test_result(fact, c, "not_null", F.col("failures"))))) for c in declared.not_null]
    for column, (parent, parent_column) in (declared.relationships or {}).items():
        named = state.where((F.col("kind") == _PARENT) & (F.col("item") == column))
        known = parents[parent].select(F.col(parent_column).cast("string").alias("key"))
        orphans = named.join(known, "key", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failures"))
        parts.append(orphans.select(F.inline(F.array(test_result(fact, column, "relationships", F.col("failures"))))))
    return reduce(DataFrame.unionByName, parts)
