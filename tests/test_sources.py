from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from conftest import rows
from fixtures import (
    BAR_HEADER,
    archive_bars,
    archive_hours,
    day_bars,
    month_of,
    pull_lines,
    weather_values,
    write_documents,
    write_pull,
)
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars import schemas
from lakebars.operators.means import daily_means
from lakebars.plans.feeds import market_silver
from lakebars.sources import archive, calendar, landing
from lakebars.sources.files import CSV_MICROS, csv_options, scan, scan_or_empty

DAYS = [date(2024, 7, 1), date(2024, 7, 2), date(2024, 8, 1)]


def bar(index, days):
    return month_of({day: day_bars(index, day) for day in days})


def test_archive_bars_become_monthly_bars_in_file_order(spark, tmp_path, zone):
    for index in schemas.INDEXES:
        for day in DAYS:
            archive_bars(tmp_path, index, day)
    archive_bars(tmp_path, "sp500", date(2024, 1, 31), offset="-05:00")
    want = [
        (index, year_month, *bar(index, days))
        for index in schemas.INDEXES
        for year_month, days in (("2024-07", DAYS[:2]), ("2024-08", DAYS[2:]))
    ] + [("sp500", "2024-01", *bar("sp500", [date(2024, 1, 31)]))]
    assert any(volume > 2**31 for _, _, volume, _, _ in want)
    for session_zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
        zone(session_zone)
        bars = market_silver(archive.market_archive(spark, str(tmp_path)).repartition(5))
        bars = bars.withColumn("ym", F.concat_ws("-", "year", "month"))
        assert rows(bars, "index_name", "ym", "max_volume", "start_open", "end_close") == sorted(want, key=repr)


def test_file_order_survives_split_files(spark, tmp_path):
    """One large day read in many pieces, next to small ones."""
    big = archive_bars(tmp_path, "sp500", DAYS[0], bars=4000)
    archive_bars(tmp_path, "sp500", DAYS[1], bars=300)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(big.stat().st_size // 9))
    try:
        bars = archive.market_archive(spark, str(tmp_path))
        assert bars.rdd.getNumPartitions() > 5
        got = [(r.Open, r.Close) for r in bars.orderBy("trade_date", "ts").collect()]
    finally:
        spark.conf.set(setting, before)
    want = [(o, c) for day, n in ((DAYS[0], 4000), (DAYS[1], 300)) for o, c, _ in day_bars("sp500", day, n)]
    assert got == want


def test_archive_takes_only_files_at_the_right_depth(spark, tmp_path):
    archive_bars(tmp_path, "sp500", DAYS[0])
    shallow = tmp_path / "sp500" / "2024" / "x.csv"
    deep = tmp_path / "sp500" / "2024" / "07" / "01" / "x.csv"
    deep.parent.mkdir(parents=True)
    for file in (shallow, deep):
        file.write_text(f"{BAR_HEADER}\n1,1,1,1,1,0,0,2024-07-01 00:00:00-04:00\n")
    assert archive.market_archive(spark, str(tmp_path)).count() == 7


def test_source_names_come_from_the_path(spark, tmp_path):
    for name in ("a b", "a+b", "plain"):
        archive_bars(tmp_path, name, DAYS[0])
    tagged = archive.scan_tagged(spark, str(tmp_path), schemas.ARCHIVE_BAR)
    assert rows(tagged.groupBy("source").count(), "source", "count") == [("a b", 7), ("a+b", 7), ("plain", 7)]


def test_weather_archive_and_its_means(spark, tmp_path):
    day, empty = date(2024, 8, 10), date(2024, 7, 10)
    archive_hours(tmp_path, day, weather_values(day))
    archive_hours(tmp_path, empty, None)
    hours = archive.weather_archive(spark, str(tmp_path))
    assert hours.count() == 48 and dict(hours.dtypes)["temperature_2m"] == "double"
    means = daily_means(hours, schemas.WEATHER_MEANS)
    got = {row.date: row for row in means.collect()}
    assert got[empty].avg_temperature is None and got[empty].avg_cloudcover is None
    assert got[day].avg_cloudcover == 46.0 and got[day].avg_precipitation == 0.1


def test_an_empty_archive_read_alone_keeps_its_types(spark, tmp_path):
    archive_hours(tmp_path, date(2024, 7, 10), None)
    assert archive.weather_archive(spark, str(tmp_path)).schema["precipitation"].dataType == T.DoubleType()


def test_a_missing_root_is_an_error(spark, tmp_path):
    missing = str(tmp_path / "nothing")
    for read in (archive.market_archive, archive.weather_archive, landing.bronze_bars, landing.bronze_hours, landing.weather_documents):
        with pytest.raises(FileNotFoundError):
            read(spark, missing)
    assert scan(spark, missing, schemas.STATE) is None  # a table of the lake may not be there yet


def test_archive_directories_may_have_any_name(spark, tmp_path):
    archive_bars(tmp_path, "sp500", DAYS[0])
    (tmp_path / "sp500" / "2024" / "7").mkdir()
    (tmp_path / "sp500" / "2024" / "07" / f"sp500_{DAYS[0]}.csv").rename(tmp_path / "sp500" / "2024" / "7" / "x.csv")
    archive_bars(tmp_path, "sp500", DAYS[2])
    assert archive.market_archive(spark, str(tmp_path)).count() == 14


def test_a_header_in_another_order_is_an_error(spark, tmp_path):
    (tmp_path / "x.csv").write_text("hour,date\n1,2024-07-01\n")
    schema = schemas.table({"date": schemas.DAY, "hour": schemas.INT})
    with pytest.raises(Exception, match="CSV header|header"):
        scan_or_empty(spark, str(tmp_path), schema, "csv", **csv_options()).collect()


def test_bad_cells_can_be_kept_aside(spark, tmp_path):
    (tmp_path / "x.csv").write_text("date,hour\n2024-07-01,1\n2024-07-01,one\n")
    schema = schemas.table({"date": schemas.DAY, "hour": schemas.INT, "_corrupt_record": schemas.TEXT})
    got = scan_or_empty(spark, str(tmp_path), schema, "csv", **csv_options())
    assert rows(got, "hour", "_corrupt_record") == [(1, None), (None, "2024-07-01,one")]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_csv_keeps_microseconds(spark, tmp_path, kind):
    path = str(tmp_path / "csv")
    df = spark.sql(f"SELECT CAST('2024-07-01 01:02:03.123457' AS {kind}) AS ts")
    df.write.options(**CSV_MICROS).csv(path)
    assert scan_or_empty(spark, path, df.schema, "csv", **csv_options()).first().ts == datetime(2024, 7, 1, 1, 2, 3, 123457)


@pytest.mark.parametrize("session_zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_pulled_bars_get_their_exchange_day(spark, tmp_path, zone, session_zone):
    zone(session_zone)
    late = "2024-07-01T03:30:00+00:00,sp500,1,1,1,1,1,0,0"  # 30 June in New York
    write_pull(tmp_path, [*pull_lines("sp500", DAYS[0]), *pull_lines("nasdaq", date(2024, 1, 2), utc_offset=-5), late])
    bars = landing.bronze_bars(spark, str(tmp_path)).rows
    got = bars.groupBy("index_name", "trade_date", "year", "month").count()
    assert rows(got, "index_name", "trade_date", "year", "month", "count") == [
        ("nasdaq", date(2024, 1, 2), "2024", "01", 7),
        ("sp500", date(2024, 6, 30), "2024", "06", 1),
        ("sp500", date(2024, 7, 1), "2024", "07", 7),
    ]


def test_hours_are_array_positions(spark, tmp_path):
    day, empty = date(2024, 8, 10), date(2024, 7, 10)
    write_documents(tmp_path, {day: weather_values(day), empty: None})
    hours = landing.hourly_rows(landing.weather_documents(spark, str(tmp_path)))
    want = [(day, h, *v) for h, v in enumerate(weather_values(day))]
    want += [(empty, h, None, None, None, None) for h in range(24)]
    assert rows(hours, "date", "hour", *schemas.WEATHER_VARIABLES) == sorted(want, key=repr)


def test_the_longest_array_decides_how_many_hours(spark, tmp_path):
    (tmp_path / "d.json").write_text(
        '{"date": "2024-08-10", "hourly": {"temperature_2m": [1.0, 2.0], "precipitation": [0.1, 0.2, 0.3],'
        ' "cloudcover": [5], "windspeed_10m": []}}\n'
        '{"date": "2024-08-11", "hourly": {"cloudcover": [7]}}\n'
    )
    hours = landing.hourly_rows(landing.weather_documents(spark, str(tmp_path)))
    assert rows(hours, "date", "hour", *schemas.WEATHER_VARIABLES) == [
        (date(2024, 8, 10), 0, 1.0, 0.1, 5.0, None),
        (date(2024, 8, 10), 1, 2.0, 0.2, None, None),
        (date(2024, 8, 10), 2, None, 0.3, None, None),
        (date(2024, 8, 11), 0, None, None, 7.0, None),
    ]


def test_variables_can_be_chosen(spark, tmp_path):
    day = date(2024, 8, 10)
    write_documents(tmp_path, {day: weather_values(day)})
    documents = landing.weather_documents(spark, str(tmp_path), schemas.document({"cloudcover": schemas.DOUBLE}))
    assert landing.hourly_rows(documents, ("cloudcover",)).columns == ["date", "hour", "cloudcover"]


def test_documents_over_several_lines(spark, tmp_path):
    (tmp_path / "d.json").write_text('{\n "date": "2024-08-10",\n "hourly": {"temperature_2m": [1.0]}\n}\n')
    documents = landing.weather_documents(spark, str(tmp_path), multi_line=True)
    assert rows(landing.hourly_rows(documents), "hour", "temperature_2m") == [(0, 1.0)]


def test_calendar_and_missing_days(spark):
    starts = spark.createDataFrame([("a", date(2024, 2, 27)), ("b", date(2024, 3, 5))], "source string, last_date date")
    due = calendar.days_due(starts, date(2024, 3, 1))
    assert rows(due, "source", "day") == [("a", date(2024, 2, 27) + timedelta(n)) for n in range(4)]
    landed = spark.createDataFrame([("a", date(2024, 2, 28)), ("b", date(2024, 2, 29))] * 3, "source string, day date")
    missing = calendar.days_missing(due, landed, ["source"])
    assert rows(missing, "day") == [(date(2024, 2, 27),), (date(2024, 2, 29),), (date(2024, 3, 1),)]
