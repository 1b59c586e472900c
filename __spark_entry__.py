"""Registered queries: each operator of the package on the given tables.

Every query reads whole tables. Queries about files first write the table (or
what Spark derives from it) into a fresh scratch folder in the layout the
operator reads, then return what the operator makes of those files. Days and
timestamps are returned as text, in the same format as the SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars import schemas
from lakebars.functions import days
from lakebars.operators import bars, lake, state
from lakebars.operators.means import daily_means
from lakebars.operators.scratch import scratch_path
from lakebars.plans import daily_run
from lakebars.plans.daily_run import RunConfig, run
from lakebars.plans.feeds import Feed, bar_states, market_feed, market_silver, weather_feed
from lakebars.plans.incremental import rebuild_pending, rebuild_since
from lakebars.sources import archive, calendar, landing
from lakebars.sources.files import CSV_MICROS, csv_options
from lakebars.streaming.arrivals import process_arrivals

try:  # the subpackage and its pipeline may be absent
    import corpus_pipeline
    from lakebars.llm import queries as llm
except ImportError as error:
    if (error.name or "").partition(".")[0] != "corpus_pipeline" and not (error.name or "").startswith("lakebars.llm"):
        raise
    llm = None

LINEITEM_TIE = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SPLIT_DAY = date(1998, 3, 15)  # inside a month


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with `day`, the DATE of the order."""
    return _table(spark, sf_dir, "orders").withColumn("day", F.col("o_orderdate").cast("date"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))


def _text(name: str) -> Column:
    return days.day_text(F.col(name)).alias(name)


# Scalars and filters


def watermark_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").filter(days.after_midnight("o_orderdate", date(2000, 1, 1)))
    return orders.select("o_orderkey", days.day_text(F.col("o_orderdate").cast("date")).alias("o_orderdate"))


def has_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state.has_new(_events(spark, sf_dir), "event_type", "day", date(2024, 1, 15))


def year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = days.with_month_parts(_orders(spark, sf_dir), "day")
    return orders.select("o_orderkey", days.year_month(F.col("day")).alias("year_month"), "year", "month")


def day_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = days.midnight(F.col("ts"))
    return _table(spark, sf_dir, "events").select("event_id", day.cast("string").alias("day"))


def day_in_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = days.day_of_utc(F.col("ts"), schemas.EXCHANGE_ZONE)
    return _table(spark, sf_dir, "events").select("event_id", days.day_text(day).alias("trade_date"))


def date_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir).withColumn("day_text", days.day_text(F.col("day")))
    return orders.select("o_orderkey", "day_text", days.text_day(F.col("day_text")).alias("day")).withColumn(
        "day", F.col("day").cast("string")
    )


def distinct_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Months are made distinct as plain dates; the text is made once for each.
    months = _orders(spark, sf_dir).select(F.trunc("day", "month").alias("first_day"))
    return lake.distinct_keys(months, ["first_day"]).select(days.year_month(F.col("first_day")).alias("year_month"))


# Aggregates


def month_bar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("index_name"),
        "l_shipdate",
        F.col("l_shipdate").cast("date").alias("day"),
        F.col("l_quantity").cast("bigint").alias("volume"),
        "l_extendedprice",
        *LINEITEM_TIE,
    )
    price = "l_extendedprice"
    result = bars.month_bars(rows, ["index_name"], "day", "l_shipdate", price, price, "volume", LINEITEM_TIE)
    return result.drop("year", "month")


def day_open_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _events(spark, sf_dir).select("event_id", "event_type", "day", "ts", "value")
    joined = bars.day_open_close(rows, ["event_type"], "day", "ts", "value", "value", ("event_id",))
    return joined.select("event_id", "start_open", "end_close")


def daily_mean_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = daily_means(_orders(spark, sf_dir), {"o_totalprice": "avg_price"}, "day")
    return means.select("year_month", _text("date"), "avg_price")


def daily_means_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    final = F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))
    orders = _orders(spark, sf_dir).select("day", final.alias("price"))
    return daily_means(orders, {"price": "avg_price"}, "day").select(_text("date"), "avg_price")


# Sources and sinks


EVENT_CSV = {
    "event_id": schemas.LONG,
    "value": schemas.DOUBLE,
    "ts": schemas.TS_NTZ,
    "event_type": schemas.TEXT,
    "year": schemas.TEXT,
    "month": schemas.TEXT,
    "date": schemas.DAY,
}


def _land_events_csv(spark: SparkSession, sf_dir: str, keys: list[str], write: Callable) -> str:
    path = scratch_path(spark, "events-csv")
    events = days.with_month_parts(_events(spark, sf_dir), "day").withColumnRenamed("day", "date")
    write(events.select(*EVENT_CSV), path, keys, "csv")
    return path


def csv_lake_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One CSV per event type and day, read back as a table."""
    path = _land_events_csv(spark, sf_dir, ["event_type", "year", "month", "date"], partial(lake.commit_partitions, options=CSV_MICROS))
    events = lake.read_partitions(spark, path, schemas.table(EVENT_CSV), "csv", **csv_options())
    return events.select("event_id", "event_type", "value", _text("date"))


def source_tag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months of CSVs of several sources in one scan, told apart by their path."""
    path = _land_events_csv(spark, sf_dir, ["event_type", "year", "month"], partial(lake.write_partitions, **CSV_MICROS))
    in_files = schemas.table({name: EVENT_CSV[name] for name in ("event_id", "value", "ts", "date")})
    tagged = archive.scan_tagged(spark, path, in_files, dirs="event_type=*/year=*/month=*")
    return tagged.groupBy("source").agg(F.count("*").alias("n"))


def landing_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "pulled")
    pulled = schemas.table(
        {"event_id": schemas.LONG, "index_name": schemas.TEXT, "ts": schemas.TS_NTZ, "value": schemas.DOUBLE}
    )
    events = _table(spark, sf_dir, "events").withColumnRenamed("event_type", "index_name")
    events.select(*pulled.names).write.options(**CSV_MICROS).csv(path)
    rows = landing.pulled_bars(spark, path, pulled)
    return rows.select(
        "event_id",
        "index_name",
        F.col("ts").cast("string").alias("ts"),
        _text("trade_date"),
        "value",
    )


def _write_documents(events: DataFrame, path: str, variables: dict[str, Column]) -> None:
    """One JSON document per day of `events`, with an array of hourly values per variable."""
    hours = (
        events
        .groupBy(F.col("day").alias("date"), F.hour("ts").alias("_hour"))
        .agg(*(value.alias(name) for name, value in variables.items()))
    )
    # A day has at most 24 of these rows.
    in_order = F.sort_array(F.collect_list(F.struct("_hour", *variables))).alias("hours")
    hourly = F.struct(*(F.col(f"hours.{name}").alias(name) for name in variables)).alias("hourly")
    hours.groupBy("date").agg(in_order).select("date", hourly).write.json(path)


def json_hourly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour as one JSON document per day, read back as rows."""
    path = scratch_path(spark, "documents")
    _write_documents(_events(spark, sf_dir), path, {"n": F.count("*"), "mx": F.max("value")})
    documents = landing.weather_documents(spark, path, schemas.document({"n": schemas.LONG, "mx": schemas.DOUBLE}))
    return landing.hourly_rows(documents, ("n", "mx")).select(_text("date"), "hour", "n", "mx")


def calendar_missing_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days without orders, for each status and priority, in a range wider than the table."""
    orders = _orders(spark, sf_dir)
    source = ["o_orderstatus", "o_orderpriority"]
    starts = orders.select(*source).distinct().withColumn("last_date", F.lit(date(1994, 12, 1)))
    missing = calendar.days_missing(calendar.days_due(starts, date(2001, 12, 31)), orders, source)
    return missing.select(*source, _text("day"))


def silver_month_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver-months")
    orders = _orders(spark, sf_dir).select(
        F.col("o_orderstatus").alias("index_name"),
        "day",
        "o_orderdate",
        "o_orderkey",
        "o_totalprice",
        "o_custkey",
    )
    price = "o_totalprice"
    months = bars.month_bars(orders, ["index_name"], "day", "o_orderdate", price, price, "o_custkey", ("o_orderkey",))
    lake.commit_partitions(months.drop("year_month"), path, schemas.SILVER_BAR_KEYS)
    return lake.read_partitions(spark, path, schemas.SILVER_BAR)


def silver_day_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "silver-days")
    means = daily_means(_orders(spark, sf_dir), {"o_totalprice": "avg_price"}, "day")
    means = days.with_month_parts(means, "date")
    lake.commit_partitions(means, path, schemas.SILVER_DAY_KEYS)
    return lake.read_partitions(spark, path, means.schema).withColumn("date", days.day_text(F.col("date")))


def month_pruned_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orders-months")
    orders = days.with_month_parts(_orders(spark, sf_dir), "day").select("o_orderkey", "year", "month")
    lake.commit_partitions(orders, path, ["year", "month"])
    return lake.read_month(spark, path, orders.schema, "1997-05").select("o_orderkey")


def day_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All days landed, days up to the 20th landed again with wrong values, then put right."""
    path = scratch_path(spark, "event-days")
    events = _events(spark, sf_dir).select("event_id", "value", "day")
    lake.commit_partitions(events, path, ["day"])
    early = events.filter(F.col("day") <= F.lit(date(2024, 1, 20)))
    lake.commit_partitions(early.withColumn("value", F.lit(-1.0)), path, ["day"])
    lake.commit_partitions(early, path, ["day"])
    return lake.read_partitions(spark, path, events.schema).withColumn("day", days.day_text(F.col("day")))


# State


def watermark_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events after their type's stored date; two types have one."""
    path = scratch_path(spark, "state")
    events = _events(spark, sf_dir)
    stored = F.when(F.col("event_type") == "click", F.lit(date(2024, 1, 10))).when(
        F.col("event_type") == "view", F.lit(date(2024, 1, 20))
    )
    state.advance(events.withColumn("stored", stored), path, schemas.PROCESSED, "event_type", "stored")
    newest = state.latest(spark, path, schemas.PROCESSED)
    rows = state.rows_after(events, "event_type", "day", newest, date(2024, 1, 1))
    return rows.select("event_id", F.col("event_type").alias("source"))


def watermark_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after a first run up to mid-January and a second over all events."""
    path = scratch_path(spark, "state")
    events = _events(spark, sf_dir)
    first = events.filter(F.col("day") <= F.lit(date(2024, 1, 15)))
    state.advance(first, path, schemas.PROCESSED, "event_type", "day")
    state.advance(events, path, schemas.PROCESSED, "event_type", "day")
    return state.latest(spark, path, schemas.PROCESSED).select("source", _text("last_date"))


# Incremental runs


def _order_months(rows: DataFrame) -> DataFrame:
    """Monthly order count, first and last price; `o_orderkey` orders a day."""
    price = "o_totalprice"
    rows = rows.withColumn("one", F.lit(1).cast("bigint"))
    months = bars.month_bars(rows, [], "day", "o_orderdate", price, price, "one", ("o_orderkey",))
    return months.withColumnRenamed("max_volume", "n").drop("year_month")


ORDER_SILVER = schemas.table(
    {
        "n": schemas.LONG,
        "start_open": schemas.DOUBLE,
        "end_close": schemas.DOUBLE,
        "year": schemas.TEXT,
        "month": schemas.TEXT,
    }
)


def _order_feed(spark: SparkSession, sf_dir: str) -> tuple[Feed, DataFrame, str]:
    root = scratch_path(spark, "order-lake")
    orders = days.with_month_parts(_orders(spark, sf_dir), "day").select(
        "o_orderkey", "o_orderdate", "o_totalprice", "year", "month", "day"
    )
    feed = Feed(
        sources=("orders",),
        bronze=f"{root}/bronze",
        bronze_schema=orders.schema,
        bronze_keys=("year", "month"),
        day="day",
        silver=f"{root}/silver",
        silver_keys=("year", "month"),
        build=_order_months,
        default=date(1995, 1, 1),
    )
    return feed, orders, root


def _read_order_silver(spark: SparkSession, feed: Feed) -> DataFrame:
    silver = lake.read_partitions(spark, feed.silver, ORDER_SILVER)
    return silver.select(F.concat_ws("-", "year", "month").alias("year_month"), "n", "start_open", "end_close")


def incremental_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings split inside a month, with an incremental run after each."""
    feed, orders, root = _order_feed(spark, sf_dir)
    early = F.col("day") <= F.lit(SPLIT_DAY)
    for part in (orders.filter(early), orders.filter(~early)):
        lake.commit_partitions(part, feed.bronze, feed.silver_keys, replaces=False)
        rebuild_since(spark, feed, f"{root}/state")
    return _read_order_silver(spark, feed)


def stream_available_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two landings, with the stream run after each."""
    feed, orders, root = _order_feed(spark, sf_dir)
    early = F.col("day") <= F.lit(SPLIT_DAY)
    for part in (orders.filter(early), orders.filter(~early)):
        lake.commit_partitions(part, feed.bronze, feed.silver_keys, replaces=False)
        process_arrivals(spark, feed, f"{root}/checkpoint")
    return _read_order_silver(spark, feed)


def _event_feed(root: str, tie: tuple[str, ...] = ("event_id",)) -> Feed:
    """Events as bars: one source per type, a day of a type replaced as a whole."""
    columns = {
        "event_id": schemas.LONG,
        "ts": schemas.TS_NTZ,
        "value": schemas.DOUBLE,
        "user_id": schemas.LONG,
        "event_type": schemas.TEXT,
        "year": schemas.TEXT,
        "month": schemas.TEXT,
        "day": schemas.DAY,
    }
    silver = ("max_volume", "start_open", "end_close", "event_type", "year", "month")
    return Feed(
        sources=EVENT_TYPES,
        bronze=f"{root}/bronze",
        bronze_schema=schemas.table(columns),
        bronze_keys=("event_type", "year", "month", "day"),
        day="day",
        silver=f"{root}/silver",
        silver_keys=("event_type", "year", "month"),
        build=lambda rows: bars.month_bars(rows, ["event_type"], "day", "ts", "value", "value", "user_id", tie).drop("year_month"),
        source_col="event_type",
        states=bar_states(schemas.table(columns), "event_type", "day", "ts", ("value", "value", "user_id"), tie, silver),
    )


EVENT_SILVER = schemas.table(
    {
        "max_volume": schemas.LONG,
        "start_open": schemas.DOUBLE,
        "end_close": schemas.DOUBLE,
        "event_type": schemas.TEXT,
        "year": schemas.TEXT,
        "month": schemas.TEXT,
    }
)


def incremental_late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days landed in the wrong order, one of them first with wrong values; a rebuild of what was touched after each."""
    root = scratch_path(spark, "event-lake")
    feed = _event_feed(root)
    events = days.with_month_parts(_events(spark, sf_dir), "day").select(*feed.bronze_schema.names)
    of_month = F.dayofmonth("day")
    wrong = events.filter(of_month == 5).withColumn("value", F.lit(-1.0)).withColumn("user_id", F.lit(10**9).cast("bigint"))
    late = [events.filter(of_month.between(11, 20)).unionByName(wrong), events.filter(of_month <= 10), events.filter(of_month > 20)]
    for part in late:
        daily_run.land(part, feed, f"{root}/state")
        rebuild_pending(spark, feed, f"{root}/state")
    return lake.read_partitions(spark, feed.silver, EVENT_SILVER)


def days_to_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days to pull after half of the events were landed, and days of that half with none, for each type."""
    root = scratch_path(spark, "event-lake")
    feed = _event_feed(root)
    events = days.with_month_parts(_events(spark, sf_dir), "day").select(*feed.bronze_schema.names)
    half = events.filter((F.dayofmonth("day") <= 15) & (F.dayofmonth("day") % 4 != 2))
    daily_run.land(half, feed, f"{root}/state")
    due = daily_run.days_to_pull(spark, RunConfig(lake=root), feed, date(2024, 1, 1), date(2024, 2, 3))
    bronze = lake.read_partitions(spark, feed.bronze, feed.bronze_schema)
    missing = daily_run.holes(spark, feed, bronze, date(2024, 1, 1), date(2024, 1, 15))
    return due.withColumn("kind", F.lit("due")).unionByName(missing.withColumn("kind", F.lit("hole"))).withColumn(
        "day", days.day_text(F.col("day"))
    )


def state_take_over(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last day of the events, kept in a text file, taken over as the state of every type; then what is newer."""
    path = scratch_path(spark, "text-state")
    events = _events(spark, sf_dir)
    last = events.filter(F.dayofmonth("day") <= 20).agg(days.day_text(F.max("day")).alias("value"))
    last.coalesce(1).write.text(f"{path}/file")
    state.take_over(spark, f"{path}/state", schemas.PROCESSED, EVENT_TYPES, f"{path}/file")
    known = state.latest(spark, f"{path}/state", schemas.PROCESSED)
    return state.rows_after(events, "event_type", "day", known, date(2024, 1, 1)).select("event_id", "event_type")


def _run(spark: SparkSession, root: str, **pulls: str) -> None:
    """The whole run over the pulls given."""
    run(spark, RunConfig(lake=root, indexes=EVENT_TYPES, bar_tie=("Open",), **pulls), raise_on_error=True)


def _pulled_events(events: DataFrame) -> DataFrame:
    """Events as the lines of a pull of bars."""
    return events.select(
        F.concat(F.col("ts").cast("string"), F.lit("+00:00")).alias("ts"),
        F.col("event_type").alias("index_name"),
        *(F.col("value").alias(name) for name in ("Open", "High", "Low", "Close")),
        F.col("user_id").alias("Volume"),
        # Keeps events of one time and value apart: a line that comes twice counts once.
        F.col("event_id").cast("double").alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"),
    )


def _write_pull(rows: DataFrame, path: str) -> str:
    rows.write.option("header", "true").csv(path)
    return path


def _weather_variables() -> dict[str, Column]:
    return {
        "temperature_2m": F.max("value"),
        "precipitation": F.min("value"),
        "cloudcover": F.count("*").cast("double"),
        "windspeed_10m": F.max("user_id").cast("double"),
    }


def daily_run_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed as bars, the whole run, and the market silver it leaves."""
    root = scratch_path(spark, "market-lake")
    pull = _write_pull(_pulled_events(_table(spark, sf_dir, "events")), f"{root}/pull/market")
    _run(spark, root, market_pull=pull)
    silver = lake.read_partitions(spark, market_feed(root).silver, schemas.SILVER_BAR)
    return silver.select(*schemas.SILVER_BAR.names)


def daily_run_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per hour landed as weather responses, the whole run, and the weather silver it leaves."""
    root = scratch_path(spark, "weather-lake")
    _write_documents(_events(spark, sf_dir), f"{root}/pull/weather", _weather_variables())
    _run(spark, root, weather_pull=f"{root}/pull/weather")
    silver = lake.read_partitions(spark, weather_feed(root).silver, schemas.SILVER_DAY)
    return silver.withColumn("date", days.day_text(F.col("date")))


def daily_run_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run of both feeds, first without, then with the days between; the silver of both."""
    root = scratch_path(spark, "both-lake")
    events = _events(spark, sf_dir).withColumn("trade_date", days.day_of_utc(F.col("ts"), schemas.EXCHANGE_ZONE))
    for late in (0, 1):
        odd = lambda day: F.dayofmonth(day) % 2 == 1 - late  # noqa: B023, E731  used at once
        market = _write_pull(_pulled_events(events.filter(odd("trade_date"))), f"{root}/pull{late}/market")
        _write_documents(events.filter(odd("day")), f"{root}/pull{late}/weather", _weather_variables())
        _run(spark, root, market_pull=market, weather_pull=f"{root}/pull{late}/weather")
    market = lake.read_partitions(spark, market_feed(root).silver, schemas.SILVER_BAR).select(
        F.col("index_name").alias("name"), F.concat_ws("-", "year", "month").alias("year_month"),
        F.col("max_volume").cast("double").alias("a"), F.col("start_open").alias("b"), F.col("end_close").alias("c"),
    )
    weather = lake.read_partitions(spark, weather_feed(root).silver, schemas.SILVER_DAY).select(
        _text("date").alias("name"), "year_month",
        F.col("avg_cloudcover").alias("a"), F.col("avg_temperature").alias("b"), F.col("avg_windspeed").alias("c"),
    )
    return market.unionByName(weather)


# Landing


def json_ragged_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Arrays of different length: `mx` ends early on most days and is absent on every fifth."""
    path = scratch_path(spark, "ragged")
    hours = F.sequence(F.lit(0), F.lit(23))
    shape = (
        _events(spark, sf_dir)
        .groupBy(F.col("day").alias("date"))
        .agg(*(F.count(F.when(F.hour("ts") == h, 1)).alias(f"h{h}") for h in range(24)))
        .withColumn("n", F.array(*(F.col(f"h{h}") for h in range(24))))
    )
    of_month = F.dayofmonth("date")
    mx = F.when(of_month % 5 != 0, F.slice(F.transform(hours, lambda h: h * 1.5), F.lit(1), of_month % 24))
    shape.select("date", F.struct("n", mx.alias("mx")).alias("hourly")).write.json(path)
    documents = landing.weather_documents(spark, path, schemas.document({"mx": schemas.DOUBLE, "n": schemas.LONG}))
    return landing.hourly_rows(documents, ("mx", "n")).select(_text("date"), "hour", "n", "mx")


def landing_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a pull with lines that cannot be placed; what lands and what is rejected, by reason."""
    path = scratch_path(spark, "pulled")
    lines = _pulled_events(_table(spark, sf_dir, "events"))
    kind = F.pmod(F.col("Dividends").cast("bigint"), F.lit(10))  # the event's id
    lines = lines.select(
        F.when(kind == 0, F.lit("soon")).otherwise(F.col("ts")).alias("ts"),
        F.when(kind == 1, F.lit(" ")).otherwise(F.col("index_name")).alias("index_name"),
        *("Open", "High", "Low", "Close"),
        F.when(kind == 2, F.lit("many")).otherwise(F.col("Volume").cast("string")).alias("Volume"),
        *("Dividends", "Stock Splits"),
    )
    landed = landing.bronze_bars(spark, _write_pull(lines, path), tie=("Open",))
    kept = landed.rows.groupBy(F.col("index_name").alias("what")).agg(F.count("*").alias("n"))
    return kept.unionByName(landed.rejects.groupBy(F.col("reason").alias("what")).agg(F.count("*").alias("n")))


def landing_duplicate_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping files of one pull; each bar counts once."""
    path = scratch_path(spark, "pulled")
    lines = _pulled_events(_table(spark, sf_dir, "events"))
    _write_pull(lines, f"{path}/all")
    _write_pull(lines.filter("Volume % 3 = 0"), f"{path}/again")
    rows = landing.bronze_bars(spark, path, tie=("Open",)).rows
    return rows.groupBy("index_name", _text("trade_date")).agg(F.count("*").alias("n"), F.sum("Volume").alias("volume"))


def month_bar_null_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars with rows that have no time: they count in the volume alone. With a tie, and without one."""
    timed = F.when(F.col("l_linenumber") != 1, F.col("l_shipdate"))
    rows = _table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("name"), F.col("l_shipdate").cast("date").alias("day"), timed.alias("ts"),
        F.col("l_quantity").cast("bigint").alias("volume"), "l_extendedprice", *LINEITEM_TIE,
    )
    price = "l_extendedprice"
    tied = bars.month_bars(rows, ["name"], "day", "ts", price, price, "volume", LINEITEM_TIE)
    # The order's key is the time of the other form: it is unique.
    key = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey"))
    orders = _orders(spark, sf_dir).select(F.col("o_orderstatus").alias("name"), "day", key.alias("ts"), "o_custkey", "o_totalprice")
    price = "o_totalprice"
    alone = bars.month_bars(orders, ["name"], "day", "ts", price, price, "o_custkey")
    return tied.withColumn("form", F.lit("tie")).unionByName(alone.withColumn("form", F.lit("alone"))).drop("year", "month")


def daily_means_fine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of values with nine decimals."""
    value = F.concat(F.col("o_orderkey"), F.lit("."), F.lpad(F.col("o_custkey").cast("string"), 9, "0")).cast("double")
    orders = _orders(spark, sf_dir).select("day", value.alias("fine"))
    return daily_means(orders, {"fine": "avg_fine"}, "day").select(_text("date"), "avg_fine")


def market_archive_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive layout `<name>/<YYYY>/<MM>/*.csv` of bars in time order, read and made into monthly bars."""
    root = scratch_path(spark, "archive")
    day = days.day_of_utc(F.col("ts"), schemas.EXCHANGE_ZONE)
    events = days.with_month_parts(_events(spark, sf_dir).withColumn("trade_date", day), "trade_date")
    columns = (
        *(F.col("value").alias(name) for name in ("Open", "High", "Low", "Close")),
        F.col("user_id").alias("Volume"),
        F.lit(0.0).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"),
        F.concat(days.day_text(F.col("trade_date")), F.lit(" 00:00:00-05:00")).alias("date"),
    )
    months = events.select("event_type", "year", "month").distinct().collect()  # one row for each directory
    for m in months:
        of_month = (F.col("event_type") == m.event_type) & (F.col("year") == m.year) & (F.col("month") == m.month)
        in_order = events.filter(of_month).coalesce(1).sortWithinPartitions("ts", "event_id").select(*columns)
        in_order.write.option("header", "true").csv(f"{root}/{m.event_type}/{m.year}/{m.month}")
    return market_silver(archive.market_archive(spark, root)).select(*schemas.SILVER_BAR.names)


def weather_archive_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive layout `<YYYY>/<MM>/*.csv` of hours, read and made into daily means."""
    root = scratch_path(spark, "archive")
    hours = _events(spark, sf_dir).groupBy("day", F.hour("ts").alias("hour"))
    hours = hours.agg(*(value.alias(name) for name, value in _weather_variables().items()))
    hours = days.with_month_parts(hours, "day")
    for m in hours.select("year", "month").distinct().collect():  # one row for each directory
        rows = hours.filter((F.col("year") == m.year) & (F.col("month") == m.month))
        rows = rows.select(_text("day").alias("date"), "hour", *schemas.WEATHER_VARIABLES)
        rows.write.option("header", "true").csv(f"{root}/{m.year}/{m.month}")
    means = daily_means(archive.weather_archive(spark, root), schemas.WEATHER_MEANS)
    return means.withColumn("date", days.day_text(F.col("date")))


def entry(spark: SparkSession) -> DataFrame:
    """Monthly bars of the smallest tables."""
    return month_bar(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return _lake_queries() | (llm.queries() | {"pipeline": corpus_pipeline.run} if llm else {})


def _lake_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "watermark_filter": watermark_filter,
        "has_new_rows": has_new_rows,
        "watermark_default": watermark_default,
        "watermark_advance": watermark_advance,
        "year_month": year_month,
        "day_normalize": day_normalize,
        "day_in_zone": day_in_zone,
        "date_text_roundtrip": date_text_roundtrip,
        "distinct_months": distinct_months,
        "day_open_close": day_open_close,
        "month_bar": month_bar,
        "daily_means": daily_mean_prices,
        "daily_means_null": daily_means_null,
        "csv_lake_scan": csv_lake_scan,
        "source_tag": source_tag,
        "landing_bars": landing_bars,
        "silver_month_roundtrip": silver_month_roundtrip,
        "silver_day_roundtrip": silver_day_roundtrip,
        "month_pruned_read": month_pruned_read,
        "day_replace": day_replace,
        "incremental_month": incremental_month,
        "stream_available_now": stream_available_now,
        "json_hourly_rows": json_hourly_rows,
        "calendar_missing_days": calendar_missing_days,
        "daily_run_market": daily_run_market,
        "daily_run_weather": daily_run_weather,
        "incremental_late_days": incremental_late_days,
        "days_to_pull": days_to_pull,
        "state_take_over": state_take_over,
        "daily_run_twice": daily_run_twice,
        "json_ragged_hours": json_ragged_hours,
        "landing_rejects": landing_rejects,
        "landing_duplicate_bars": landing_duplicate_bars,
        "month_bar_null_ts": month_bar_null_ts,
        "daily_means_fine": daily_means_fine,
        "market_archive_bars": market_archive_bars,
        "weather_archive_days": weather_archive_days,
    }


_DAY = "strftime({0}, '%Y-%m-%d')"
_MONTH = "strftime({0}, '%Y-%m')"
_TRADE_DATE = "CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE)"
_MEAN = """CASE WHEN count({0}) = 0 THEN NULL ELSE
  CAST((2 * sum(CAST(round({0} * 100) AS BIGINT)) + count({0})) // (2 * count({0})) AS DOUBLE) / 100 END"""

_EVENT_BAR = """CAST(sum(user_id) AS BIGINT) AS max_volume,
              first(value ORDER BY ts, value) AS start_open, last(value ORDER BY ts, value) AS end_close"""


def oracle_sql() -> dict[str, str]:
    return _lake_sql() | (llm.oracle_sql() if llm else {})


def _lake_sql() -> dict[str, str]:
    order_months = f"""SELECT {_MONTH.format('o_orderdate')} AS year_month, count(*) AS n,
          first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS start_open,
          last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS end_close
        FROM orders GROUP BY 1"""
    weather_days = f"""WITH h AS (SELECT CAST(ts AS DATE) AS d, hour(ts) AS h, max(value) AS t,
                min(value) AS p, CAST(count(*) AS DOUBLE) AS c, CAST(max(user_id) AS DOUBLE) AS w
              FROM events GROUP BY 1, 2)
            SELECT {_MONTH.format('d')} AS year_month, {_DAY.format('d')} AS date,
              {_MEAN.format('t')} AS avg_temperature, {_MEAN.format('p')} AS avg_precipitation,
              {_MEAN.format('c')} AS avg_cloudcover, {_MEAN.format('w')} AS avg_windspeed,
              strftime(d, '%Y') AS year, strftime(d, '%m') AS month FROM h GROUP BY d"""
    return {
        "watermark_filter": f"""SELECT o_orderkey, {_DAY.format('o_orderdate')} AS o_orderdate
            FROM orders WHERE CAST(o_orderdate AS DATE) > DATE '2000-01-01'""",
        "has_new_rows": """SELECT event_type AS source, CAST(max(ts) AS DATE) > DATE '2024-01-15' AS has_new
            FROM events GROUP BY event_type""",
        "watermark_default": """WITH st(source, last_date) AS
              (VALUES ('click', DATE '2024-01-10'), ('view', DATE '2024-01-20'))
            SELECT e.event_id, e.event_type AS source FROM events e LEFT JOIN st ON st.source = e.event_type
            WHERE CAST(e.ts AS DATE) > coalesce(st.last_date, DATE '2024-01-01')""",
        "watermark_advance": f"""SELECT event_type AS source, {_DAY.format('max(ts)')} AS last_date
            FROM events GROUP BY event_type""",
        "year_month": f"""SELECT o_orderkey, {_MONTH.format('o_orderdate')} AS year_month,
              strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month FROM orders""",
        "day_normalize": """SELECT event_id, CAST(CAST(date_trunc('day', ts) AS TIMESTAMP) AS VARCHAR) AS day FROM events""",
        "day_in_zone": f"SELECT event_id, {_DAY.format(_TRADE_DATE)} AS trade_date FROM events",
        "date_text_roundtrip": f"""SELECT o_orderkey, {_DAY.format('o_orderdate')} AS day_text,
              CAST(CAST({_DAY.format('o_orderdate')} AS DATE) AS VARCHAR) AS day FROM orders""",
        "distinct_months": f"SELECT DISTINCT {_MONTH.format('o_orderdate')} AS year_month FROM orders",
        "day_open_close": """SELECT event_id, first_value(value) OVER w AS start_open, last_value(value) OVER w AS end_close
            FROM events WINDOW w AS (PARTITION BY event_type, CAST(ts AS DATE) ORDER BY ts, event_id
              ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
        "month_bar": f"""SELECT l_returnflag AS index_name, {_MONTH.format('l_shipdate')} AS year_month,
              CAST(sum(l_quantity) AS BIGINT) AS max_volume,
              first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS start_open,
              last(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS end_close
            FROM lineitem GROUP BY 1, 2""",
        "daily_means": f"""SELECT {_MONTH.format('o_orderdate')} AS year_month, {_DAY.format('o_orderdate')} AS date,
              {_MEAN.format('o_totalprice')} AS avg_price FROM orders GROUP BY 1, 2""",
        "daily_means_null": f"""SELECT {_DAY.format('o_orderdate')} AS date, {_MEAN.format('p')} AS avg_price
            FROM (SELECT o_orderdate, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS p FROM orders) GROUP BY 1""",
        "csv_lake_scan": f"SELECT event_id, event_type, value, {_DAY.format('ts')} AS date FROM events",
        "source_tag": "SELECT event_type AS source, count(*) AS n FROM events GROUP BY event_type",
        "landing_bars": f"""SELECT event_id, event_type AS index_name, CAST(ts AS VARCHAR) AS ts,
              {_DAY.format(_TRADE_DATE)} AS trade_date, value FROM events""",
        "silver_month_roundtrip": """SELECT o_orderstatus AS index_name, strftime(o_orderdate, '%Y') AS year,
              strftime(o_orderdate, '%m') AS month, CAST(sum(o_custkey) AS BIGINT) AS max_volume,
              first(o_totalprice ORDER BY o_orderdate, o_orderkey) AS start_open,
              last(o_totalprice ORDER BY o_orderdate, o_orderkey) AS end_close FROM orders GROUP BY 1, 2, 3""",
        "silver_day_roundtrip": f"""SELECT {_MONTH.format('o_orderdate')} AS year_month, {_DAY.format('o_orderdate')} AS date,
              {_MEAN.format('o_totalprice')} AS avg_price, strftime(o_orderdate, '%Y') AS year,
              strftime(o_orderdate, '%m') AS month FROM orders GROUP BY 1, 2, 4, 5""",
        "month_pruned_read": f"SELECT o_orderkey FROM orders WHERE {_MONTH.format('o_orderdate')} = '1997-05'",
        "day_replace": f"SELECT event_id, {_DAY.format('ts')} AS day, value FROM events",
        "incremental_month": order_months,
        "stream_available_now": order_months,
        "json_hourly_rows": f"""WITH h AS (SELECT CAST(ts AS DATE) AS d, hour(ts) AS h, count(*) AS n, max(value) AS mx
              FROM events GROUP BY 1, 2)
            SELECT {_DAY.format('d')} AS date, CAST(row_number() OVER (PARTITION BY d ORDER BY h) - 1 AS INTEGER) AS hour,
              n, mx FROM h""",
        "calendar_missing_days": f"""WITH c AS (SELECT o_orderstatus, o_orderpriority,
                CAST(unnest(generate_series(DATE '1994-12-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d
              FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders))
            SELECT o_orderstatus, o_orderpriority, {_DAY.format('d')} AS day FROM c
            ANTI JOIN (SELECT DISTINCT o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS d FROM orders) o
              USING (o_orderstatus, o_orderpriority, d)""",
        "daily_run_market": f"""SELECT event_type AS index_name, strftime({_TRADE_DATE}, '%Y') AS year,
              strftime({_TRADE_DATE}, '%m') AS month, {_EVENT_BAR} FROM events GROUP BY 1, 2, 3""",
        "market_archive_bars": f"""SELECT event_type AS index_name, strftime({_TRADE_DATE}, '%Y') AS year,
              strftime({_TRADE_DATE}, '%m') AS month, {_EVENT_BAR.replace("ORDER BY ts, value", "ORDER BY ts, event_id")}
            FROM events GROUP BY 1, 2, 3""",
        "daily_run_weather": weather_days,
        "weather_archive_days": weather_days.replace("strftime(d, '%Y') AS year, strftime(d, '%m') AS month", "").replace("avg_windspeed,", "avg_windspeed"),
        "daily_run_twice": f"""SELECT event_type AS name, strftime({_TRADE_DATE}, '%Y-%m') AS year_month,
              CAST(sum(user_id) AS DOUBLE) AS a, first(value ORDER BY ts, value) AS b, last(value ORDER BY ts, value) AS c
            FROM events GROUP BY 1, 2
            UNION ALL SELECT date, year_month, avg_cloudcover, avg_temperature, avg_windspeed FROM ({weather_days})""",
        "incremental_late_days": f"""SELECT event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
              {_EVENT_BAR.replace("ORDER BY ts, value", "ORDER BY ts, event_id")} FROM events GROUP BY 1, 2, 3""",
        "days_to_pull": f"""WITH h AS (SELECT DISTINCT event_type AS source, CAST(ts AS DATE) AS d FROM events
                WHERE day(ts) <= 15 AND day(ts) % 4 <> 2),
              s AS (SELECT unnest(['{"', '".join(EVENT_TYPES)}']) AS source),
              due AS (SELECT source, CAST(unnest(generate_series(coalesce(l, DATE '2024-01-01'), DATE '2024-02-03', INTERVAL 1 DAY)) AS DATE) AS d
                FROM s LEFT JOIN (SELECT source, max(d) AS l FROM h GROUP BY source) USING (source)),
              c AS (SELECT source, CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-15', INTERVAL 1 DAY)) AS DATE) AS d FROM s)
            SELECT source, {_DAY.format('d')} AS day, 'due' AS kind FROM due
            UNION ALL SELECT source, {_DAY.format('d')}, 'hole' FROM c ANTI JOIN h USING (source, d)""",
        "state_take_over": """SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) >
              (SELECT max(CAST(ts AS DATE)) FROM events WHERE day(ts) <= 20)""",
        "json_ragged_hours": f"""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events),
              h AS (SELECT d, unnest(generate_series(0, 23)) AS h FROM d),
              n AS (SELECT CAST(ts AS DATE) AS d, hour(ts) AS h, count(*) AS n FROM events GROUP BY 1, 2)
            SELECT {_DAY.format('d')} AS date, CAST(h AS INTEGER) AS hour, coalesce(n, 0) AS n,
              CASE WHEN day(d) % 5 <> 0 AND h < day(d) % 24 THEN CAST(h * 1.5 AS DOUBLE) END AS mx
            FROM h LEFT JOIN n USING (d, h)""",
        "landing_rejects": """SELECT CASE event_id % 10 WHEN 0 THEN 'no time' WHEN 1 THEN 'no index' WHEN 2 THEN 'unreadable'
              ELSE event_type END AS what, count(*) AS n FROM events GROUP BY 1""",
        "landing_duplicate_bars": f"""SELECT event_type AS index_name, {_DAY.format(_TRADE_DATE)} AS trade_date, count(*) AS n,
              CAST(sum(user_id) AS BIGINT) AS volume FROM events GROUP BY 1, 2""",
        "month_bar_null_ts": f"""WITH t AS (SELECT l_returnflag AS name, {_MONTH.format('l_shipdate')} AS year_month,
                CAST(sum(l_quantity) AS BIGINT) AS max_volume,
                first(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)
                  FILTER (WHERE l_linenumber <> 1) AS start_open,
                last(l_extendedprice ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)
                  FILTER (WHERE l_linenumber <> 1) AS end_close
              FROM lineitem GROUP BY 1, 2),
            o AS (SELECT o_orderstatus, {_MONTH.format('o_orderdate')}, CAST(sum(o_custkey) AS BIGINT),
                first(o_totalprice ORDER BY o_orderkey) FILTER (WHERE o_orderkey % 3 <> 0),
                last(o_totalprice ORDER BY o_orderkey) FILTER (WHERE o_orderkey % 3 <> 0) FROM orders GROUP BY 1, 2)
            SELECT *, 'tie' AS form FROM t UNION ALL SELECT *, 'alone' FROM o""",
        "daily_means_fine": f"""SELECT {_DAY.format('o_orderdate')} AS date, CAST((2 * sum(CAST(o_orderkey AS HUGEINT) * 1000000000 + o_custkey)
                + count(*) * 10000000) // (2 * count(*) * 10000000) AS DOUBLE) / 100 AS avg_fine
            FROM orders GROUP BY 1""",
    }
