from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakebars import schemas
from lakebars.operators import lake, state
from lakebars.operators.scratch import scratch_path

KEYS = ["year", "month"]


def months(spark, data):
    return spark.createDataFrame(data, "x int, year string, month string")


def test_only_partitions_present_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    first = months(spark, [(1, "2024", "07"), (2, "2024", "08"), (3, "2024", "08")])
    lake.write_partitions(first, path, KEYS)
    lake.write_partitions(months(spark, [(9, "2024", "08")]), path, KEYS)
    got = lake.read_partitions(spark, path, first.schema)
    assert rows(got, "x", "year", "month") == [(1, "2024", "07"), (9, "2024", "08")]


def test_files_can_be_added(spark, tmp_path):
    path = str(tmp_path / "t")
    df = months(spark, [(1, "2024", "07")])
    for _ in range(2):
        lake.write_partitions(df, path, KEYS, replace=False)
    assert lake.read_partitions(spark, path, df.schema).count() == 2


def test_one_file_per_partition_whatever_the_input_parts(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(5000).selectExpr("id", "'2024' AS year", "lpad(id % 12 + 1, 2, '0') AS month").repartition(16)
    lake.write_partitions(df, str(path), KEYS)
    assert all(len(list(folder.glob("*.parquet"))) == 1 for folder in path.glob("year=*/month=*"))


def test_a_large_partition_is_split_by_its_own_rows(spark, tmp_path):
    path = tmp_path / "t"
    df = spark.range(40_000, numPartitions=16).selectExpr(
        "id", "uuid() AS pad", "'2024' AS year", "IF(id % 3 = 0, '01', lpad(id % 12 + 1, 2, '0')) AS month"
    )
    lake.write_partitions(df, str(path), KEYS, rows_per_file=5_000)
    files = {folder.name: len(list(folder.glob("*.parquet"))) for folder in (path / "year=2024").iterdir()}
    assert files.pop("month=01") == 3 and set(files.values()) == {1}
    assert lake.read_partitions(spark, str(path), df.schema).count() == 40_000


def test_many_small_partitions_get_few_files(spark, tmp_path):
    path = tmp_path / "t"
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.shuffle.partitions": "4"}
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        df = spark.range(200_000, numPartitions=32).selectExpr("id", "'2024' AS year", "lpad(id % 200, 3, '0') AS month")
        lake.write_partitions(df, str(path), KEYS)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert len(list(path.glob("**/*.parquet"))) == 200


def test_writes_in_parallel_leave_the_session_as_it_was(spark, tmp_path):
    before = dict(spark.conf.getAll)
    df = spark.range(2000).selectExpr("id", "'2024' AS year", "lpad(id % 12 + 1, 2, '0') AS month")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda n: lake.write_partitions(df, str(tmp_path / str(n)), KEYS), range(4)))
    assert dict(spark.conf.getAll) == before
    assert all(lake.read_partitions(spark, str(tmp_path / str(n)), df.schema).count() == 2000 for n in range(4))


def test_month_read_lists_that_month_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = months(spark, [(n, "2024", f"{n:02d}") for n in range(1, 13)])
    lake.write_partitions(df, path, KEYS)
    got = lake.read_month(spark, path, df.schema, "2024-08")
    assert rows(got, "x", "year", "month") == [(8, "2024", "08")]
    assert len(got.inputFiles()) == 1
    assert lake.read_month(spark, path, df.schema, "2025-08").isEmpty()


@pytest.mark.parametrize("name", ["a b", "a+b", "a%b", "a=b/c:d", "é?*[x]{y}", "a'b\"c\\d^e#f"])
def test_directories_are_found_by_any_name(spark, tmp_path, name):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, name, "01"), (2, "other", "01"), (3, name, "02")], "x int, s string, m string")
    lake.write_partitions(df, path, ["s", "m"])
    got = lake.read_named(spark, path, df.schema, ["s", "m"], [{"s": name, "m": "01"}, {"s": "none", "m": "01"}])
    assert rows(got, "x", "s", "m") == [(1, name, "01")]
    assert rows(lake.read_named(spark, path, df.schema, ["s", "m"], [{"m": "01"}]), "x") == [(1,), (2,)]


def test_table_not_written_yet_is_empty(spark, tmp_path):
    assert lake.read_month(spark, str(tmp_path / "none"), schemas.SILVER_BAR, "2024-08").isEmpty()


def test_distinct_keys(spark):
    got = lake.distinct_keys(months(spark, [(1, "2024", "07"), (2, "2024", "07")]), KEYS)
    assert rows(got, "year", "month") == [("2024", "07")]


def seen(spark, data):
    return spark.createDataFrame(data, "s string, d date")


def test_state_keeps_sources_and_stages_apart(spark, tmp_path):
    path = str(tmp_path / "state")
    state.advance(seen(spark, [("a", date(2024, 7, 1)), ("a", date(2024, 7, 3)), ("b", None)]), path, "processed", "s", "d")
    state.advance(seen(spark, [("a", date(2024, 9, 1))]), path, "loaded", "s", "d")
    assert rows(state.latest(spark, path, "processed"), "source", "last_date") == [("a", date(2024, 7, 3))]
    default = date(2024, 1, 1)
    want = {"a": date(2024, 7, 3), "b": default}
    assert state.starts(spark, path, "processed", ["a", "b"], default) == want


def test_state_newest_commit_wins_even_when_earlier(spark, tmp_path):
    path = str(tmp_path / "state")
    for last in (date(2024, 7, 3), date(2024, 5, 1)):
        state.advance(seen(spark, [("a", last)]), path, "processed", "s", "d")
    assert rows(state.latest(spark, path, "processed"), "last_date") == [(date(2024, 5, 1),)]


def test_state_is_compacted(spark, tmp_path):
    path = str(tmp_path / "state")
    for day in range(1, 8):
        state.advance(seen(spark, [("a", date(2024, 7, day)), ("b", date(2024, 6, day))]), path, "processed", "s", "d")
        state.advance(seen(spark, [("a", date(2024, 8, day))]), path, "loaded", "s", "d")
    assert not state.compact(spark, path, files=20)
    assert state.compact(spark, path, files=5)
    assert len(list(Path(path).glob("*.parquet"))) == 1
    want = [("a", date(2024, 7, 7)), ("b", date(2024, 6, 7))]
    assert rows(state.latest(spark, path, "processed"), "source", "last_date") == want
    assert rows(state.latest(spark, path, "loaded"), "source", "last_date") == [("a", date(2024, 8, 7))]


def test_state_not_written_yet(spark, tmp_path):
    path = str(tmp_path / "state")
    assert state.latest(spark, path, "processed").isEmpty()
    assert state.starts(spark, path, "processed", ["a"], date(2024, 1, 1)) == {"a": date(2024, 1, 1)}


def test_rows_after_uses_the_default_for_unknown_sources(spark, tmp_path):
    path = str(tmp_path / "state")
    df = seen(spark, [(s, date(2024, 7, n)) for s in "ab" for n in (1, 2, 3)])
    state.advance(df.filter("s = 'a' AND d < DATE'2024-07-03'"), path, "processed", "s", "d")
    known = state.latest(spark, path, "processed")
    got = state.rows_after(df, "s", "d", known, date(2024, 7, 1))
    assert rows(got, "s", "d") == [("a", date(2024, 7, 3)), ("b", date(2024, 7, 2)), ("b", date(2024, 7, 3))]
    got = state.rows_after(df, "s", "d", known, date(2024, 7, 3), inclusive=True)
    assert rows(got, "s", "d") == [("a", date(2024, 7, 2)), ("a", date(2024, 7, 3)), ("b", date(2024, 7, 3))]


def test_has_new(spark):
    df = seen(spark, [("a", date(2024, 7, 1)), ("b", date(2024, 7, 2)), ("c", None)])
    got = state.has_new(df, "s", "d", date(2024, 7, 1))
    assert rows(got, "source", "has_new") == [("a", False), ("b", True), ("c", False)]


def test_scratch_lies_in_the_checkpoint_folder(spark):
    path = scratch_path(spark, "x")
    assert path.startswith(spark.conf.get("spark.checkpoint.dir")) and not Path(path).exists()
    assert path != scratch_path(spark, "x")


def test_commit_times_are_recorded(spark, tmp_path):
    path = str(tmp_path / "state")
    state.advance(seen(spark, [("a", date(2024, 7, 1))]), path, "loaded", "s", "d")
    row = spark.read.schema(schemas.STATE).parquet(path).select("*", F.current_timestamp().alias("now")).first()
    assert row.stage == "loaded" and datetime(2020, 1, 1) < row.committed_at <= row.now


def test_a_date_kept_in_a_text_file_is_taken_over(spark, tmp_path):
    path, file = str(tmp_path / "state"), tmp_path / "last.txt"
    file.write_text("2024-10-15")
    state.take_over(spark, path, "processed", ["a", "b"], str(file))
    assert rows(state.latest(spark, path, "processed"), "source", "last_date") == [
        ("a", date(2024, 10, 15)),
        ("b", date(2024, 10, 15)),
    ]
    file.write_text("not a date")
    state.take_over(spark, str(tmp_path / "other"), "processed", ["a"], str(file))
    assert state.latest(spark, str(tmp_path / "other"), "processed").isEmpty()
