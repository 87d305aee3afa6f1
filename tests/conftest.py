from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("terrace-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# Modules of very many jobs over a few rows each: compiling them takes longer than running them.
INTERPRETED = ("test_pipeline", "test_streaming", "test_incremental", "test_sources")


@pytest.fixture(autouse=True, scope="module")
def without_code_generation(request):
    if request.module.__name__.rpartition(".")[2] not in INTERPRETED:
        yield
        return
    conf = request.getfixturevalue("spark").conf
    settings = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    before = {key: conf.get(key, None) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    yield
    for key, value in before.items():
        conf.unset(key) if value is None else conf.set(key, value)
