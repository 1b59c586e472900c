"""Files a pull has landed: CSV bars with their time, JSON weather responses; and archives that are taken over."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars import schemas
from lakebars.functions.days import day_of_instant, day_of_utc, with_month_parts
from lakebars.operators.scratch import settle
from lakebars.sources.archive import MONTH_DIRS, placed_bars, scan_months
from lakebars.sources.files import csv_options, scan_present

BAD_LINE = "_corrupt_record"


@dataclass(frozen=True)
class Landed:
    """Rows of a pull in bronze shape, and what could not be placed (`schemas.REJECT`)."""

    rows: DataFrame
    rejects: DataFrame


def _with_bad_line(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(BAD_LINE, schemas.TEXT)])


def _parted(read: DataFrame, reason: Column, columns: Sequence[str], scratch: str | None) -> Landed:
    """Rows without a reason, and the others with theirs. The files are read once, here."""
    read = settle(read.withColumn("_reason", reason), "pulled", scratch)
    line = F.coalesce(F.col(BAD_LINE), F.to_json(F.struct(*columns)))
    bad = read.filter(F.col("_reason").isNotNull())
    rejects = bad.select(F.col("_reason").alias("reason"), line.alias("line"), F.col("_file").alias("file"), F.current_timestamp().alias("landed_at"))
    return Landed(read.filter(F.col("_reason").isNull()).drop("_reason", "_file", BAD_LINE), rejects)


def _reasons(*named: tuple[str, Column]) -> Column:
    """The first reason that holds, or null."""
    return F.coalesce(*(F.when(holds, F.lit(name)) for name, holds in named))


def pulled_bars(
    spark: SparkSession,
    path: str,
    schema: T.StructType = schemas.PULLED_BAR,
    ts: str = "ts",
    zone: str = schemas.EXCHANGE_ZONE,
) -> DataFrame:
    """Landed bars with `trade_date`, the day of the bar at its exchange; a missing `path` is an error."""
    bars = scan_present(spark, path, schema, "csv", **csv_options(recursiveFileLookup="true"))
    return _with_trade_date(bars, schema, ts, zone)


def _with_trade_date(bars: DataFrame, schema: T.StructType, ts: str, zone: str) -> DataFrame:
    day = day_of_utc if isinstance(schema[ts].dataType, T.TimestampNTZType) else day_of_instant
    return bars.withColumn("trade_date", day(F.col(ts), zone))


def distinct_bars(bars: DataFrame, keys: Sequence[str], tie: Sequence[str] = (), scratch: str | None = None) -> DataFrame:
    """Bars that were pulled twice, alike in every column, once.

    Two bars of one time that differ are an error, unless `tie` orders them:
    nothing here could tell which of them is right. The result is written, since
    a landing reads it several times.
    """
    once = settle(bars.distinct(), "bars", scratch)
    if not tie:
        clash = once.groupBy(*keys).count().filter("count > 1").first()
        if clash is not None:
            named = ", ".join(f"{key}={clash[key]}" for key in keys)
            raise ValueError(f"{clash['count']} different bars of {named}; name the columns that order them, or mend the pull")
    return once


def bronze_bars(
    spark: SparkSession, path: str, zone: str = schemas.EXCHANGE_ZONE, tie: Sequence[str] = (), scratch: str | None = None
) -> Landed:
    """Bars of a pull, each once. A line that cannot be read in full, or has no time or index, is rejected."""
    schema = schemas.PULLED_BAR
    options = csv_options(recursiveFileLookup="true", columnNameOfCorruptRecord=BAD_LINE)
    read = scan_present(spark, path, _with_bad_line(schema), "csv", **options).withColumn("_file", F.col("_metadata.file_path"))
    reason = _reasons(
        ("no time", F.col("ts").isNull()),
        ("no index", F.coalesce(F.trim("index_name"), F.lit("")) == ""),
        ("unreadable", F.col(BAD_LINE).isNotNull()),
    )
    parted = _parted(read, reason, schema.names, scratch)
    bars = with_month_parts(_with_trade_date(parted.rows, schema, "ts", zone), "trade_date")
    bars = distinct_bars(bars.select(*schemas.BRONZE_BAR.names), ("index_name", "ts"), tie, scratch)
    return Landed(bars, parted.rejects)


def hourly_rows(documents: DataFrame, variables: tuple[str, ...] = schemas.WEATHER_VARIABLES) -> DataFrame:
    """One row per day and array position; the position is the hour.

    The longest array decides how many hours a document has; another that is
    shorter or absent gives nulls. A document with no values has no rows.
    """
    arrays = (F.coalesce(f"hourly.{name}", F.array()).alias(name) for name in variables)
    return documents.select("date", F.posexplode(F.arrays_zip(*arrays)).alias("hour", "_at")).select(
        "date", "hour", *(F.col(f"_at.{name}").alias(name) for name in variables)
    )


def weather_documents(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = False
) -> DataFrame:
    """Landed responses, one JSON document per line (or per file); a missing `path` is an error."""
    return scan_present(
        spark,
        path,
        schema or schemas.document(),
        "json",
        recursiveFileLookup="true",
        multiLine=str(multi_line).lower(),
        columnNameOfCorruptRecord=BAD_LINE,
    )


def bronze_hours(spark: SparkSession, path: str, multi_line: bool = False, scratch: str | None = None) -> Landed:
    """Hours of a pull. A document that cannot be read, or has no day or no values at all, is rejected."""
    schema = schemas.document()
    read = weather_documents(spark, path, _with_bad_line(schema), multi_line).withColumn("_file", F.col("_metadata.file_path"))
    sizes = (F.coalesce(F.size(F.coalesce(f"hourly.{name}", F.array())), F.lit(0)) for name in schemas.WEATHER_VARIABLES)
    reason = _reasons(
        ("unreadable", F.col(BAD_LINE).isNotNull()),
        ("no day", F.col("date").isNull()),
        ("no values", F.greatest(*sizes) == 0),
    )
    parted = _parted(read, reason, schema.names, scratch)
    # A day that comes twice alike counts once; its hours would otherwise weigh double in the means.
    hours = with_month_parts(hourly_rows(parted.rows.distinct()), "date").select(*schemas.BRONZE_HOUR.names)
    clash = hours.groupBy("date", "hour").count().filter("count > 1").first()
    if clash is not None:
        raise ValueError(f"{clash['count']} different documents of {clash['date']}; mend the pull")
    return Landed(hours, parted.rejects)


def archived_bars(
    spark: SparkSession, root: str, indexes: Sequence[str], zone: str = schemas.EXCHANGE_ZONE, scratch: str | None = None
) -> Landed:
    """Bars of `archive.market_archive`. A line that cannot be read in full, or has no day, or is of another index, is rejected."""
    schema = schemas.ARCHIVE_BAR
    read = scan_months(spark, root, f"*/{MONTH_DIRS}", _with_bad_line(schema), columnNameOfCorruptRecord=BAD_LINE)
    read = placed_bars(read.withColumn("_file", F.col("_metadata.file_path")), zone)
    reason = _reasons(
        ("no time", F.col("date").isNull()),
        ("unreadable", F.col(BAD_LINE).isNotNull()),
        ("unknown index", ~F.col("index_name").isin(list(indexes))),
    )
    parted = _parted(read, reason, ["index_name", *schema.names], scratch)
    return Landed(with_month_parts(parted.rows, "trade_date").select(*schemas.BRONZE_BAR.names), parted.rejects)


def archived_hours(spark: SparkSession, root: str, scratch: str | None = None) -> Landed:
    """Hours of `archive.weather_archive`. A line that cannot be read in full, or has no day, is rejected."""
    schema = schemas.ARCHIVE_HOUR
    read = scan_months(spark, root, MONTH_DIRS, _with_bad_line(schema), columnNameOfCorruptRecord=BAD_LINE)
    read = read.withColumn("_file", F.col("_metadata.file_path"))
    reason = _reasons(("no day", F.col("date").isNull()), ("unreadable", F.col(BAD_LINE).isNotNull()))
    parted = _parted(read, reason, schema.names, scratch)
    return Landed(with_month_parts(parted.rows, "date").select(*schemas.BRONZE_HOUR.names), parted.rejects)
