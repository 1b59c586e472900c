"""The daily CSV archives: `<source>/<YYYY>/<MM>/<file>.csv`.

All sources are read in one scan and told apart by their path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars import schemas
from lakebars.functions.days import day_of_instant, with_month_parts
from lakebars.sources.files import csv_options, directories, scan_present

# Directories of whole months, whatever their names. The driver resolves months
# instead of every file, and Spark lists the files in parallel.
MONTH_DIRS = "*/*"


def scan_months(spark: SparkSession, root: str, dirs: str, schema: T.StructType, **options: str) -> DataFrame:
    """The CSV files directly inside directories `root/dirs`; an error if there are no such directories."""
    pattern = f"{root.rstrip('/')}/{dirs}"
    return scan_present(spark, directories(spark, pattern) or pattern, schema, "csv", **csv_options(pathGlobFilter="*.csv", **options))


def source_of_path(path: Column, levels: int = 3) -> Column:
    """Name of the directory `levels` above the file, its value if `key=value`.

    Plain byte searches: this runs for every row, where a regular expression
    would cost more than reading the row.
    """
    name = F.substring_index(F.substring_index(path, "/", -(levels + 1)), "/", 1)
    name = F.substring_index(name, "=", -1)
    # Paths are encoded; a plus sign is itself there, which url_decode would make a space.
    decoded = F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))
    return F.when(F.contains(name, F.lit("%")), decoded).otherwise(name)


def scan_tagged(
    spark: SparkSession, root: str, schema: T.StructType, tag: str = "source", dirs: str = f"*/{MONTH_DIRS}"
) -> DataFrame:
    """All sources below `root` in one scan, each row with its source.

    The first directory of the pattern `dirs` names the source.
    """
    files = scan_months(spark, root, dirs, schema)
    levels = dirs.count("/") + 1
    return files.withColumn(tag, source_of_path(F.col("_metadata.file_path"), levels))


def place_in_file() -> Column:
    """A number that grows along the rows of each file.

    The row counter restarts with each piece of a file Spark reads, so the
    piece's byte offset is added: a piece starts further in, counted in bytes,
    than any task before it has rows.
    """
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1).cast("bigint"))
    return F.col("_metadata.file_block_start") + row


def market_archive(spark: SparkSession, root: str, zone: str = schemas.EXCHANGE_ZONE) -> DataFrame:
    """Archived bars in bronze shape.

    The archive keeps the day of a bar but not its hour; bars stand in time
    order in their file. `ts` becomes the day's midnight plus one microsecond
    per place, which keeps that order in one sortable column.
    """
    bars = placed_bars(scan_months(spark, root, f"*/{MONTH_DIRS}", schemas.ARCHIVE_BAR), zone)
    return with_month_parts(bars, "trade_date").select(*schemas.BRONZE_BAR.names)


def placed_bars(files: DataFrame, zone: str) -> DataFrame:
    """Rows of archive files with `index_name`, `ts` and `trade_date`."""
    return files.withColumns(
        {
            "index_name": source_of_path(F.col("_metadata.file_path")),
            "ts": F.timestamp_micros(F.unix_micros("date") + place_in_file()),
            "trade_date": day_of_instant(F.col("date"), zone),
        }
    )


def weather_archive(spark: SparkSession, root: str) -> DataFrame:
    """Archived weather hours in bronze shape."""
    files = scan_months(spark, root, MONTH_DIRS, schemas.ARCHIVE_HOUR)
    return with_month_parts(files, "date").select(*schemas.BRONZE_HOUR.names)
