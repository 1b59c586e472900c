"""Binary files through Spark's own writer, so that a lost task leaves no half file behind."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_files(contents: DataFrame, column: str, path: str, ending: bytes) -> None:
    """One file for each row of `contents`, holding the bytes of `column` and then `ending`.

    The text writer puts out the bytes of a value as they are and its line
    separator after each; `ending`, the last bytes of the file format, is that
    separator. Works on every file system Spark writes to.
    """
    (
        contents.select(F.col(column).cast("string"))
        .write.option("lineSep", ending.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", 1)
        .option("compression", "none")
        .text(path)
    )


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """`path, content` of every file; files are bounded by their writer."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")
