from __future__ import annotations

import time

import pytest

from terrace.session import drops_shuffles

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles().mkString(" ").split()
    return {f for f in files if f.rsplit("/", 1)[-1].startswith("shuffle_")}


@drops_shuffles
def write(spark, path):
    spark.range(0, 10_000, 1, 4).repartition(3, "id").write.parquet(path)


def test_shuffle_files_leave_with_the_action(spark, tmp_path):
    spark.conf.set(KEY, "false")
    try:
        before = shuffle_files(spark)
        write(spark, str(tmp_path / "t"))
        # Removed on the side.
        for _ in range(50):
            if not (left := shuffle_files(spark) - before):
                break
            time.sleep(0.1)
        assert not left and spark.read.parquet(str(tmp_path / "t")).count() == 10_000
    finally:
        spark.conf.unset(KEY)


def test_the_setting_is_restored_after_the_last_call(spark):
    before, seen = spark.conf.get(KEY, None), []

    @drops_shuffles
    def inner(spark):
        seen.append(spark.conf.get(KEY))
        raise KeyError

    @drops_shuffles
    def outer(spark):
        with pytest.raises(KeyError):
            inner(spark)
        seen.append(spark.conf.get(KEY))

    outer(spark)
    assert seen == ["true", "true"] and spark.conf.get(KEY, None) == before
