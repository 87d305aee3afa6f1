"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import math
import os
from datetime import date, datetime
from pathlib import Path

import duckdb
import pytest

from terrace.workload.oracles import ORACLES
from terrace.workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(value, date):
        return value.isoformat()
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    actual = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    expected_columns = [d[0] for d in expected.description]
    assert sorted(actual.columns) == sorted(expected_columns)
    got = _sorted_rows(actual.columns, [tuple(r) for r in actual.collect()])
    want = _sorted_rows(expected_columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want
