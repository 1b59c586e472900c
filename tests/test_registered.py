"""Every registered query against its SQL, on whole tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registered

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


QUERIES = {name: query for name, query in registered.queries().items() if name != "pipeline" and not name.startswith("op")}


def test_each_query_has_its_sql():
    assert QUERIES.keys() == {name for name in registered.oracle_sql() if not name.startswith("op")}


ZONED = ("watermark_filter", "day_in_zone", "landing_bars", "daily_run_market", "daily_run_weather")


@pytest.mark.parametrize("name", ZONED)
@pytest.mark.parametrize("session_zone", ["Asia/Tokyo", "America/New_York"])
def test_query_does_not_depend_on_the_session_zone(spark, oracle, zone, name, session_zone):
    zone(session_zone)
    test_query_equals_its_sql(spark, oracle, name)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, oracle, name):
    got = registered.queries()[name](spark, SF_DIR)
    want = oracle.sql(registered.oracle_sql()[name])
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    rows = sorted((tuple(row[n] for n in names) for row in got.collect()), key=repr)
    places = [want.columns.index(n) for n in names]
    assert rows == sorted((tuple(row[p] for p in places) for row in want.fetchall()), key=repr)
    assert rows


def test_entry_has_rows(spark):
    assert registered.entry(spark).count() > 0
