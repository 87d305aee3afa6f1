from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators.dedup import distinct_by_key, latest_version
from tests.helpers import plan, rows

SCHEMA = "k string, t int, v string"


def test_newest_wins_and_null_version_loses(spark):
    df = spark.createDataFrame(
        [("a", 1, "old"), ("a", 2, "new"), ("a", None, "never"), ("b", None, "only")], SCHEMA
    )
    assert rows(latest_version(df, ["k"], ["t"])) == [("a", 2, "new"), ("b", None, "only")]


def test_null_key_is_one_group(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "y"), ("a", 1, "z")], SCHEMA)
    assert rows(distinct_by_key(df, ["k"])) == [(None, 2, "y"), ("a", 1, "z")]


def test_distinct_on_all_columns(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    assert rows(distinct_by_key(df, ["k"])) == [(None,), ("a",)]


records = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.one_of(st.none(), st.integers(0, 3)),
        st.sampled_from(["x", "y", "z"]),
    ),
    min_size=1,
    max_size=20,
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=records, parts=st.integers(1, 6))
def test_winner_does_not_depend_on_partitioning(spark, data, parts):
    best = {}
    for k, t, v in data:
        rank = (t is not None, t or 0, v)
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, t, v))
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    assert rows(latest_version(df, ["k"], ["t"])) == sorted(
        (r for _, r in best.values()), key=lambda r: tuple(map(str, r))
    )


def test_rank_filter_limits_groups_before_the_shuffle(spark):
    df = spark.range(10).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    text = plan(latest_version(df, ["k"], ["t"]))
    physical = text[text.index("== Physical Plan ==") :]
    assert physical.count("WindowGroupLimit") == 2
    exchange = physical.index("Exchange hashpartitioning")
    assert physical.index("Final") < exchange < physical.index("Partial")


def test_hot_key_leaves_one_row_per_task(spark):
    """One key holds nearly all rows; what crosses the exchange is bounded by the tasks."""
    df = spark.range(0, 100_000, 1, 8).select(
        F.when(F.col("id") % 1000 == 0, F.col("id")).otherwise(F.lit(-1)).alias("k"),
        F.col("id").alias("t"),
    )
    latest = latest_version(df, ["k"], ["t"])
    assert latest.count() == 101
    assert latest.where("k = -1").first()["t"] == 99_999
