from __future__ import annotations

import random
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from terrace.operators.incremental import changes_since, merge_frames, watermark
from terrace.operators import keyed_table
from terrace.operators.keyed_table import KeyedTable
from terrace.staging import new_folder, staged, work_base
from tests.helpers import executed_plan, plan, rows

SCHEMA = "k string, t int, v string"


def frame(spark, *records):
    return spark.createDataFrame(list(records), SCHEMA)


def times(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return df.select(F.col("s").cast("timestamp").alias("at"))


# --- watermark ----------------------------------------------------------------


def test_watermark_is_strict(spark):
    target = times(spark, "2024-01-01 10:00:00", "2024-01-01 09:00:00")
    source = times(spark, "2024-01-01 09:59:59", "2024-01-01 10:00:00", "2024-01-01 10:00:01")
    changed = changes_since(source, target, "at")
    assert [r[0] for r in changed.select(F.col("at").cast("string")).collect()] == [
        "2024-01-01 10:00:01"
    ]


def test_empty_target_has_the_default_watermark(spark):
    empty = times(spark)
    assert watermark(empty, "at").select(F.col("watermark").cast("string")).first()[0] == (
        "1900-01-01 00:00:00"
    )
    old = times(spark, "1900-01-01 00:00:00", "1900-01-01 00:00:01")
    assert changes_since(old, empty, "at").count() == 1


def test_first_run_takes_everything_even_null_times(spark):
    source = times(spark, "1800-01-01 00:00:00", None)
    assert changes_since(source, None, "at").count() == 2


def test_watermark_is_one_subquery_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    times(spark, "2024-01-01 10:00:00").write.parquet(path)
    text = plan(changes_since(spark.read.parquet(path), spark.read.parquet(path), "at"))
    assert "GreaterThan(at,ScalarSubquery" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


# --- upsert -------------------------------------------------------------------


def keyed(spark, tmp_path, buckets=4):
    return KeyedTable(spark, str(tmp_path / "fact"), "k", buckets, cluster_by=["t"], index_rows=1)


def test_insert_replace_and_keep(spark, tmp_path):
    table = keyed(spark, tmp_path)
    assert not table.exists()
    table.upsert(frame(spark, ("a", 1, "x"), ("b", 1, "x")))
    table.upsert(frame(spark, ("b", 2, "y"), ("c", 2, "y")))
    assert rows(table.read()) == [("a", 1, "x"), ("b", 2, "y"), ("c", 2, "y")]


def test_repeated_keys_in_one_batch_keep_the_newest(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, ("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y")), newest_first=["t"])
    assert rows(table.read()) == [("a", 3, "z")]


def test_rows_without_key_are_refused(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 4, cluster_by=["t"])
    with pytest.raises(ValueError, match="without k"):
        table.upsert(frame(spark, ("a", 1, "x"), (None, 1, "y")))
    assert not table.exists()
    table.upsert(frame(spark, ("a", 1, "x")))
    with pytest.raises(ValueError, match="without k"):
        table.upsert(frame(spark, (None, 1, "y")))
    assert rows(table.read().select("k")) == [("a",)]


def test_empty_changes(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, ("a", 1, "x")))
    table.upsert(frame(spark))
    assert rows(table.read()) == [("a", 1, "x")]


def test_first_load_without_rows(spark, tmp_path):
    schema = frame(spark).schema
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 4, schema=schema)
    assert table.read().count() == 0
    table.upsert(frame(spark))
    assert not table.exists() and rows(table.read()) == []
    table.upsert(frame(spark, ("a", 1, "x")))
    assert table.exists() and rows(table.read()) == [("a", 1, "x")]


def stored_files(table):
    return {str(f) for f in Path(table.path, "rows").rglob("*.parquet")}


def test_a_small_batch_rewrites_no_file(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=3)
    table.upsert(frame(spark, *[(f"k{i}", 1, "x") for i in range(60)]))
    before = stored_files(table)
    table.upsert(frame(spark, ("k0", 2, "y"), ("new", 2, "y")))
    assert before < stored_files(table)
    want = [(f"k{i}", 1, "x") for i in range(1, 60)] + [("k0", 2, "y"), ("new", 2, "y")]
    assert rows(table.read()) == sorted(want)


def test_reading_shuffles_only_buckets_with_replaced_rows(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, *[(f"k{i}", 1, "x") for i in range(60)]))
    table.upsert(frame(spark, ("new", 2, "y")))
    assert "Join" not in executed_plan(table.read())
    table.upsert(frame(spark, ("k0", 2, "y")))
    assert "Join" in executed_plan(table.read())


def test_the_index_opens_only_files_that_may_hold_a_key(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, fold_share=9, max_deltas=99, index_rows=1)
    for n in range(6):
        table.upsert(frame(spark, *[(f"k{n}-{i}", n, "x") for i in range(200)]))
    assert len(stored_files(table)) == 12
    keys = table._bucketed(frame(spark, ("k3-7", 9, "y"), ("absent", 9, "y")).select("k"))
    live = table._live()
    files = table._files_that_may_hold(keys, live)
    assert len(files) == 1 and rows(table._open("rows", files, None).where("k = 'k3-7'").select("t")) == [(3,)]
    assert rows(table.lookup(keys.select("k"))) == [("k3-7", 3, "x")]
    every = table._bucketed(frame(spark, *[(f"k{n}-5", 9, "") for n in range(6)]).select("k"))
    assert 6 <= len(table._files_that_may_hold(every, live)) <= 7
    assert rows(table.lookup(frame(spark, ("absent", 0, "")).select("k"))) == []


def test_without_the_index_the_result_is_the_same(spark, tmp_path):
    for name, limit in (("few", 1000), ("many", 0)):
        table = KeyedTable(spark, str(tmp_path / name), "k", 4, ["t"], index_keys=limit, index_rows=1)
        table.upsert(frame(spark, *[(f"k{i}", 1, "x") for i in range(40)]))
        table.upsert(frame(spark, *[(f"k{i}", 2, "y") for i in range(30, 50)]))
        assert table.read().count() == 50
        assert table.read().where("t = 2").count() == 20


@pytest.mark.parametrize("step", ["_write_index", "_commit"])
def test_a_run_killed_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch, step):
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, fold_share=9, index_rows=1)
    table.upsert(frame(spark, ("a", 1, "x"), ("b", 1, "x")))
    before, opened = rows(table.read()), table.read()

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(table, step, die)
        with pytest.raises(KeyboardInterrupt):
            table.upsert(frame(spark, ("b", 2, "y"), ("c", 2, "y")))
    assert rows(table.read()) == before and table.commit_number() == 1
    assert len({f.split("delta_version=")[1].split("/")[0] for f in stored_files(table)}) == 2
    table.upsert(frame(spark, ("b", 3, "z")))
    assert rows(table.read()) == [("a", 1, "x"), ("b", 3, "z")]
    assert rows(opened) == before
    # What the dead run left has gone.
    assert len({f.split("delta_version=")[1].split("/")[0] for f in stored_files(table)}) == 2


def test_a_fold_killed_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, fold_rows=1)
    table.upsert(frame(spark, *[(f"k{i}", 1, "x") for i in range(10)]))
    with monkeypatch.context() as broken:
        broken.setattr(table, "_fold", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            table.upsert(frame(spark, *[(f"k{i}", 2, "y") for i in range(9)]))
    # The upsert itself had been committed.
    assert table.read().where("t = 2").count() == 9 and table.read().count() == 10


def test_deltas_fold_when_they_pass_their_share_or_number(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 1, fold_share=0.5, max_deltas=2, fold_rows=1)
    model = {f"k{i}": 0 for i in range(40)}
    table.upsert(frame(spark, *[(k, t, "v") for k, t in model.items()]))
    parts = []
    for n in range(1, 8):
        load = {f"k{n}": n, f"new{n}": n, f"k{n - 1}": n}
        table.upsert(frame(spark, *[(k, t, "v") for k, t in load.items()]))
        model |= load
        assert rows(table.read()) == sorted((k, t, "v") for k, t in model.items())
        parts.append(len(table._live()))
    assert parts[:2] == [2, 3] and max(parts) <= 4 and 1 in parts or 2 in parts[2:]


def test_a_large_load_is_folded_as_it_is_written(spark, tmp_path):
    """One commit a load, nothing marked as replaced, one part a bucket."""
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, fold_rows=1)
    table.upsert(frame(spark, *[(f"k{i}", t, "x") for i in range(20) for t in (1, 2)]), ["t"])
    load = [(f"k{i}", t, v) for i in range(10, 30) for t, v in ((5, "a"), (5, "b"), (None, "z"))]
    want = [(f"k{i}", 2, "x") for i in range(10)] + [(f"k{i}", 5, "b") for i in range(10, 30)]
    for number in (2, 3):
        table.upsert(frame(spark, *load), ["t"])
        assert rows(table.read()) == sorted(want) and "Join" not in executed_plan(table.read())
        assert table.commit_number() == number and len(table._live()) == 2
        assert not Path(table.path, "gone").exists()


def test_a_load_of_few_keys_and_a_small_one_are_not_folded_as_written(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed_table, "_SHARE_ROWS", 8)
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, fold_rows=1)
    table.upsert(frame(spark, *[(f"k{i}", 1, "x") for i in range(200)]), ["t"])
    hot = frame(spark, *[("k7", t, "hot") for t in range(300)])
    assert not table._upsert_and_fold(hot, ["t"])
    table.upsert(hot, ["t"])
    assert not table._upsert_and_fold(frame(spark, ("k8", 2, "y"), ("new", 2, "y")), ["t"])
    table.upsert(frame(spark, ("k8", 2, "y"), ("new", 2, "y")), ["t"])
    changed = {"k7": (299, "hot"), "k8": (2, "y"), "new": (2, "y")}
    want = {f"k{i}": (1, "x") for i in range(200)} | changed
    assert rows(table.read()) == sorted((k, *v) for k, v in want.items())


def test_random_loads_folded_as_written_or_not(spark, tmp_path):
    rng, model = random.Random(11), {}
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, max_deltas=1, fold_rows=1, keep_seconds=0)
    for n in range(7):
        load = [(f"k{rng.randrange(30)}", rng.randrange(9), "v") for _ in range(rng.choice([1, 3, 40]))]
        table.upsert(frame(spark, *load), ["t"])
        model |= {k: t for k, t, _ in sorted(load)}
        assert rows(table.read()) == sorted((k, t, "v") for k, t in model.items())


def test_a_large_stored_load_is_folded_as_it_is_written(spark, tmp_path, monkeypatch):
    """One commit a load and no marked rows; what it replaced is known all the same."""
    monkeypatch.setattr(keyed_table, "_SHARE_ROWS", 8)
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 2, ["t"], fold_rows=1)
    rng, model = random.Random(5), {}
    for number in range(1, 5):
        load = {f"k{i}": (number, str(rng.randrange(3))) for i in rng.sample(range(60), 50)}
        lost = {k: model[k] for k in load if k in model}
        days = spark.createDataFrame([(k, *r) for k, r in load.items()], SCHEMA)
        days = days.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.col("t")))
        done = table.upsert_stored(days, note="day", carry=["v"])
        assert (done.before, done.after, table.commit_number()) == (number - 1, number, number)
        assert sorted({d.day - 1 for d in done.days}) == sorted({t for t, _ in lost.values()})
        replaced = table.replaced(done.version)
        found = [] if replaced is None else rows(replaced.select("k", "v"))
        assert found == sorted((k, v) for k, (_, v) in lost.items())
        model |= load
        assert rows(table.read().drop("day")) == sorted((k, *r) for k, r in model.items())
        assert "Join" not in executed_plan(table.read()) and len(table._live()) == 2


def test_folders_leave_only_after_their_time(spark, tmp_path):
    for keep, left in ((3600, 3), (0, 1)):
        table = KeyedTable(spark, str(tmp_path / str(keep)), "k", 1, fold_share=9, keep_seconds=keep)
        table.upsert(frame(spark, ("a", 1, "x")))
        table.upsert(frame(spark, ("a", 2, "x")))
        table.compact()
        table.compact() if keep == 0 else None
        versions = {f.split("delta_version=")[1].split("/")[0] for f in stored_files(table)}
        assert len(versions) == left
        assert rows(table.read()) == [("a", 2, "x")]


def test_compaction_keeps_the_rows(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=2)
    for n in range(4):
        table.upsert(frame(spark, *[(f"k{n}-{i}", n, "x") for i in range(5)], ("all", n, "x")))
    before = rows(table.read())
    table.compact()
    assert rows(table.read()) == before
    assert len(table.read().inputFiles()) == 2 and "Join" not in executed_plan(table.read())


def test_changes_may_read_the_target(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.upsert(frame(spark, ("a", 1, "x"), ("b", 1, "x")))
    table.upsert(table.read().withColumn("t", F.col("t") + 1))
    assert rows(table.read()) == [("a", 2, "x"), ("b", 2, "x")]


def test_notes_are_the_days_of_replaced_rows_and_come_before_the_commit(spark, tmp_path):
    def at(*records):
        return spark.createDataFrame(list(records), "k string, day string").select("k", F.to_date("day").alias("day"))

    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 4)
    seen = []

    def look(days, commit):
        seen.append(([str(d) for d in days], commit, table.commit_number()))

    first = at(("a", "2024-01-01"), ("b", "2024-01-02"), ("c", None))
    assert table.upsert_stored(first, note="day", before_commit=look).days == []
    again = table.upsert_stored(at(("b", "2024-02-01"), ("c", "2024-02-01")), note="day", before_commit=look)
    assert [str(d) for d in again.days] == ["2024-01-02"]
    assert seen == [([], 1, 0), (["2024-01-02"], 2, 1)]


def test_bucket_count_is_fixed(spark, tmp_path):
    keyed(spark, tmp_path, buckets=4).upsert(frame(spark, ("a", 1, "x")))
    with pytest.raises(ValueError, match="bucket_of_4"):
        keyed(spark, tmp_path, buckets=8).upsert(frame(spark, ("a", 2, "y")))


def test_random_loads_lookups_and_folds(spark, tmp_path):
    """Against a dictionary, with parts folded early and often."""
    rng, model = random.Random(4), {}
    table = KeyedTable(spark, str(tmp_path / "fact"), "k", 3, fold_share=0.7, max_deltas=1, fold_rows=1, index_rows=5, keep_seconds=0)
    for n in range(6):
        load = {f"k{rng.randrange(30)}": n for _ in range(rng.choice([1, 4, 25]))}
        table.upsert(frame(spark, *[(k, t, "v") for k, t in load.items()]))
        model |= load
        asked = [f"k{rng.randrange(30)}" for _ in range(5)]
        keys = spark.createDataFrame([(k,) for k in set(asked)], "k string")
        assert rows(table.lookup(keys)) == sorted((k, model[k], "v") for k in set(asked) if k in model)
        assert rows(table.read()) == sorted((k, t, "v") for k, t in model.items())


batches = st.lists(
    st.dictionaries(st.sampled_from("abcdef"), st.integers(0, 9), min_size=1, max_size=5),
    min_size=1,
    max_size=3,
)


@settings(max_examples=3, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(loads=batches)
def test_upsert_is_a_dictionary_update_and_idempotent(spark, loads):
    table = KeyedTable(spark, new_folder(spark, "prop"), "k", 3)
    model: dict[str, int] = {}
    for load in loads:
        df = frame(spark, *[(k, t, "v") for k, t in load.items()])
        table.upsert(df)
        table.upsert(df)
        model |= load
        assert rows(table.read()) == [(k, t, "v") for k, t in sorted(model.items())]


def test_merge_frames(spark):
    merged = merge_frames(
        frame(spark, ("a", 1, "x"), ("b", 1, "x")), frame(spark, ("b", 2, "y"), ("c", 2, "y")), "k"
    )
    assert rows(merged) == [("a", 1, "x"), ("b", 2, "y"), ("c", 2, "y")]


# --- staging ------------------------------------------------------------------


def test_staged_table_is_read_back_and_dropped(spark):
    with staged(frame(spark, ("a", 1, "x")), "unit") as table:
        folder = table.inputFiles()[0]
        assert rows(table) == [("a", 1, "x")]
        assert work_base(spark) in folder
    assert not Path(folder.removeprefix("file://")).exists()
