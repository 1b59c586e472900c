from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakebars.operators.scratch import remove
from lakebars.operators.bars import day_open_close, month_bars, open_close

SCHEMA = "s string, ts timestamp_ntz, tie bigint, o double, c double, v bigint"


def make(n=600, seed=3):
    """Rows of three sources with many equal times; one source holds most rows."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 30, 22)
    data = []
    for tie in range(n):
        source = "hot" if rng.random() < 0.7 else rng.choice(["a", None])
        ts = start + timedelta(hours=rng.randrange(24 * 40))
        data.append((source, ts, tie, rng.random(), rng.random(), rng.randrange(5_000_000_000)))
    return data


def expected(data, key):
    groups = {}
    for row in data:
        groups.setdefault((row[0], key(row[1])), []).append(row)
    result = []
    for (source, part), members in groups.items():
        members.sort(key=lambda r: (r[1], r[2]))
        result.append((source, part, sum(r[5] for r in members), members[0][3], members[-1][4]))
    return sorted(result, key=repr)


def bars_of(df, tie=("tie",)):
    df = df.withColumn("day", F.col("ts").cast("date"))
    return month_bars(df, ["s"], "day", "ts", "o", "c", "v", tie)


NAMES = ("s", "year_month", "max_volume", "start_open", "end_close")


@pytest.mark.parametrize("parts", [1, 7, 16])
def test_month_bars_do_not_depend_on_row_order(spark, parts):
    data = make()
    want = expected(data, lambda ts: ts.strftime("%Y-%m"))
    random.Random(parts).shuffle(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(parts)
    assert rows(bars_of(df), *NAMES) == want
    assert any(volume > 2**31 for _, _, volume, _, _ in want)


def test_month_bars_same_when_groups_are_shuffled_instead_of_broadcast(spark):
    data = make()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    thresholds = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    try:
        for name in thresholds:
            spark.conf.set(name, "-1")
        bars = bars_of(df)
        assert "BroadcastHashJoin" not in bars._jdf.queryExecution().toString()
        assert rows(bars, *NAMES) == expected(data, lambda ts: ts.strftime("%Y-%m"))
    finally:
        for name in thresholds:
            spark.conf.unset(name)


def test_groups_that_share_a_hash_stay_apart(spark, monkeypatch):
    """With a hash of only two values every group meets the rows of others."""
    monkeypatch.setattr(F, "xxhash64", lambda *keys: F.pmod(F.hash(*keys), F.lit(2)).cast("bigint"))
    data = make()
    df = spark.createDataFrame(data, SCHEMA).withColumn("day", F.col("ts").cast("date"))
    assert rows(bars_of(df), *NAMES) == expected(data, lambda ts: ts.strftime("%Y-%m"))
    ends = {(s, d): (o, c) for s, d, _, o, c in expected(data, lambda ts: ts.date())}
    got = day_open_close(df, ["s"], "day", "ts", "o", "c", ("tie",))
    want = [(r[2], *ends[r[0], r[1].date()]) for r in data]
    assert rows(got, "tie", "start_open", "end_close") == sorted(want, key=repr)


def test_unique_times_need_one_hash_aggregation(spark):
    start = datetime(2024, 1, 30)
    data = [("a", start + timedelta(hours=n), n, float(n), n + 0.5, n) for n in range(200)]
    random.Random(1).shuffle(data)
    bars = bars_of(spark.createDataFrame(data, SCHEMA).repartition(6), tie=())
    plan = bars._jdf.queryExecution().toString()
    assert "SortAggregate" not in plan and "HashAggregate" in plan and "Join" not in plan
    assert rows(bars, *NAMES) == expected(data, lambda ts: ts.strftime("%Y-%m"))


def test_rows_without_a_time_count_in_the_sums(spark):
    data = [("a", None, 1, 9.0, 9.0, 100), ("a", datetime(2024, 2, 1), 2, 1.0, 2.0, 5), ("b", None, 3, 4.0, 4.0, 7)]
    df = spark.createDataFrame(data, SCHEMA)
    for tie in ((), ("tie",)):
        bars = open_close(df, ["s"], "ts", "o", "c", tie, {"v": "v"})
        assert rows(bars, "s", "v", "start_open", "end_close") == [("a", 105, 1.0, 2.0), ("b", 7, None, None)]


def test_a_callers_folder_holds_what_is_written_meanwhile(spark, tmp_path):
    df = spark.createDataFrame([("a", datetime(2024, 2, 1), 2, 1.0, 2.0, 5)], SCHEMA)
    bars = open_close(df, ["s"], "ts", "o", "c", ("tie",), scratch=str(tmp_path))
    assert bars.count() == 1 and any(tmp_path.iterdir())
    remove(spark, str(tmp_path))
    assert not tmp_path.exists()


def test_null_values_stay_null(spark):
    data = [("a", datetime(2024, 2, 1), 2, None, 2.0, 5), ("a", datetime(2024, 2, 2), 2, 1.0, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    for tie in ((), ("tie",)):
        bars = open_close(df, ["s"], "ts", "o", "c", tie, {"v": "v"})
        assert rows(bars, "s", "v", "start_open", "end_close") == [("a", 5, None, None)]


@pytest.mark.parametrize("parts", [1, 9])
def test_day_open_close_keeps_every_row(spark, parts):
    data = make() + [("a", None, -1, 0.0, 0.0, 1)]
    df = spark.createDataFrame(data, SCHEMA).withColumn("day", F.col("ts").cast("date")).repartition(parts)
    got = day_open_close(df, ["s"], "day", "ts", "o", "c", ("tie",))
    ends = {(s, d): (o, c) for s, d, _, o, c in expected(data[:-1], lambda ts: ts.date())}
    want = [(r[2], *(ends[(r[0], r[1].date())] if r[1] else (None, None))) for r in data]
    assert rows(got, "tie", "start_open", "end_close") == sorted(want, key=repr)


def test_day_open_close_does_not_move_the_rows(spark):
    df = spark.createDataFrame(make(), SCHEMA).withColumn("day", F.col("ts").cast("date"))
    plan = day_open_close(df, ["s"], "day", "ts", "o", "c", ("tie",))._jdf.queryExecution().toString()
    assert "Window" not in plan and "Exchange hashpartitioning" not in plan


def test_month_of_the_day_column_counts_not_of_the_instant(spark):
    data = [("a", datetime(2024, 7, 1, 2), 1, 1.0, 1.0, 1)]  # 30 June in New York
    df = spark.createDataFrame(data, SCHEMA).withColumn("day", F.lit(date(2024, 6, 30)))
    bars = month_bars(df, ["s"], "day", "ts", "o", "c", "v")
    assert rows(bars, "year_month", "year", "month") == [("2024-06", "2024", "06")]
