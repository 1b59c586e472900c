"""Reads with a declared schema: a lake's own table may not be there yet, a configured root must be."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame | None:
    """Files under `path`, or None when there are none.

    Partition columns named in `schema` keep their declared type, so month 08
    stays text.
    """
    try:
        return spark.read.schema(schema).format(fmt).options(**options).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, made without a Python worker."""
    return spark.range(0).select(*(F.lit(None).cast(field.dataType).alias(field.name) for field in schema))


def scan_or_empty(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    found = scan(spark, path, schema, fmt, **options)
    return found if found is not None else empty(spark, schema)


def directories(spark: SparkSession, pattern: str) -> list[str]:
    """The directories, not files, that match a pattern."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return [status.getPath().toString() for status in found or [] if status.isDirectory()]


def scan_present(
    spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files under `path`; an error if it does not exist, since a mistyped root would look like a quiet day."""
    found = scan(spark, path, schema, fmt, **options)
    if found is None:
        raise FileNotFoundError(f"no such files: {path}")
    return found


def csv_options(**options: str) -> dict[str, str]:
    """Header files whose column names must match the declared schema.

    With enforceSchema on, a header in another order would bind by position
    and give wrong columns without an error.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        # Offsets in the text win; text without one is read as UTC.
        "timeZone": "UTC",
        **options,
    }


# The CSV writer prints milliseconds unless told otherwise.
CSV_MICROS = {
    "header": "true",
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
}
