from __future__ import annotations

from types import SimpleNamespace

import pytest

from terrace import staging
from tests.helpers import rows


def session(master, folder):
    settings = {} if folder is None else {"spark.checkpoint.dir": folder}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: settings.get(key, default)),
        sparkContext=SimpleNamespace(master=master),
    )


def test_the_named_shared_folder_is_used():
    assert staging.work_base(session("yarn", "hdfs:///shared/ck/")) == "hdfs:///shared/ck"
    assert staging.new_folder(session("yarn", "hdfs:///ck"), "x").startswith("hdfs:///ck/terrace-x-")


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        staging.work_base(session("spark://host:7077", None))


def test_a_local_session_may_use_its_own(monkeypatch, tmp_path):
    monkeypatch.setattr(staging, "_local_base", None)
    monkeypatch.setattr(staging.tempfile, "mkdtemp", lambda prefix: str(tmp_path / prefix))
    assert staging.work_base(session("local[4]", None)) == str(tmp_path / "terrace-")


def test_failed_block_drops_the_table_too(spark):
    folders = []
    with pytest.raises(KeyError), staging.staged(spark.range(3), "unit") as table:
        folders.append(table.inputFiles()[0])
        raise KeyError
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        rows(spark.read.parquet(folders[0]))
