from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakebars.functions import days

ZONES = ["UTC", "America/New_York", "America/Los_Angeles", "Asia/Tokyo"]
CASES = [
    ("2024-07-01 00:00:00-04:00", date(2024, 7, 1)),  # midnight in summer
    ("2024-01-02 00:00:00-05:00", date(2024, 1, 2)),  # midnight in winter
    ("2024-07-01 03:59:59.999999+00:00", date(2024, 6, 30)),
    ("2024-07-01 04:00:00+00:00", date(2024, 7, 1)),
    ("2024-11-03 05:30:00+00:00", date(2024, 11, 3)),  # 01:30, first time that night
    ("2024-11-03 06:30:00+00:00", date(2024, 11, 3)),  # 01:30 again
    ("1969-12-31 23:00:00-05:00", date(1969, 12, 31)),
    ("1965-03-01 00:00:00-05:00", date(1965, 3, 1)),
]


@pytest.mark.parametrize("session_zone", ZONES)
def test_day_of_instant_ignores_the_session_zone(spark, zone, session_zone):
    zone(session_zone)
    df = spark.createDataFrame(CASES, "text string, want date").withColumn("ts", F.col("text").cast("timestamp"))
    got = df.select("text", days.day_of_instant(F.col("ts"), "America/New_York").alias("day"))
    assert rows(got, "text", "day") == sorted(CASES, key=repr)


@pytest.mark.parametrize("session_zone", ZONES)
def test_day_of_utc_and_month_ignore_the_session_zone(spark, zone, session_zone):
    zone(session_zone)
    df = spark.createDataFrame([(datetime(2024, 7, 1, 3, 59),)], "ts timestamp_ntz")
    day = days.day_of_utc(F.col("ts"), "America/New_York")
    got = days.with_month_parts(df.withColumn("day", day), "day")
    got = got.select("day", days.year_month(F.col("day")).alias("ym"), "year", "month")
    assert rows(got, "day", "ym", "year", "month") == [(date(2024, 6, 30), "2024-06", "2024", "06")]


@pytest.mark.parametrize("session_zone", ZONES)
def test_both_ways_to_a_day_agree(spark, zone, session_zone):
    """Every ten minutes around the clock changes of a year."""
    zone(session_zone)
    start, step = datetime(2024, 3, 9), timedelta(minutes=10)
    times = [start + step * n for n in range(600)] + [datetime(2024, 11, 2) + step * n for n in range(600)]
    df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
    zoned = F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.col("ts")).cast("date")
    instant = F.concat(F.col("ts").cast("string"), F.lit("+00:00")).cast("timestamp")
    got = df.select(
        zoned.alias("want"),
        days.day_of_utc(F.col("ts"), "America/New_York").alias("utc"),
        days.day_of_instant(instant, "America/New_York").alias("instant"),
    )
    assert got.filter("want <> utc OR want <> instant").isEmpty()


def test_midnight_keeps_the_type(spark):
    df = spark.createDataFrame([(datetime(2024, 7, 1, 3, 59),)], "ts timestamp_ntz")
    got = df.select(days.midnight(F.col("ts")).alias("day"))
    assert got.dtypes == [("day", "timestamp_ntz")]
    assert got.first().day == datetime(2024, 7, 1)


def test_text_that_is_no_date_gives_null(spark):
    df = spark.createDataFrame([("2024-07-01",), ("2024-13-01",), ("x",)], "t string")
    got = df.select(days.text_day(F.col("t")).alias("d"))
    assert rows(got, "d") == sorted([(date(2024, 7, 1),), (None,), (None,)], key=repr)


@pytest.mark.parametrize("session_zone", ZONES)
@pytest.mark.parametrize("inclusive, want", [(False, [3]), (True, [1, 2, 3])])
def test_after_is_strict_unless_asked(spark, zone, session_zone, inclusive, want):
    zone(session_zone)
    data = [
        (0, datetime(2024, 6, 30, 23, 59, 59)),
        (1, datetime(2024, 7, 1)),
        (2, datetime(2024, 7, 1, 23, 59, 59, 999999)),
        (3, datetime(2024, 7, 2)),
        (4, None),
    ]
    df = spark.createDataFrame(data, "id int, ts timestamp_ntz").withColumn("day", F.col("ts").cast("date"))
    last = date(2024, 7, 1)
    assert rows(df.filter(days.after("day", last, inclusive)), "id") == [(i,) for i in want]
    assert rows(df.filter(days.after_midnight("ts", last, inclusive)), "id") == [(i,) for i in want]


def test_after_midnight_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(datetime(2024, 7, 1),)], "ts timestamp_ntz").write.parquet(path)
    plan = spark.read.parquet(path).filter(days.after_midnight("ts", date(2024, 7, 1)))
    assert "GreaterThanOrEqual(ts,2024-07-02T00:00)" in plan._jdf.queryExecution().toString()
