"""High-water dates: an append-only table, one row per source and run."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars.functions.days import text_day
from lakebars.operators.scratch import remove, settle
from lakebars.operators.versions import append
from lakebars.schemas import STATE
from lakebars.sources.files import scan_or_empty


def latest(spark: SparkSession, path: str, stage: str) -> DataFrame:
    """`source, last_date`: the newest commit of each source."""
    newest = F.struct("committed_at", "last_date")
    return (
        scan_or_empty(spark, path, STATE)
        .filter(F.col("stage") == stage)
        .groupBy("source")
        .agg(F.max_by("last_date", newest).alias("last_date"))
    )


def starts(spark: SparkSession, path: str, stage: str, sources: Iterable[str], default: date) -> dict[str, date]:
    """Last date of each configured source, the default where none is stored.

    `sources` is the caller's own list, so the result is as long as that.
    """
    wanted = list(sources)
    stored = latest(spark, path, stage).filter(F.col("source").isin(wanted))
    return dict.fromkeys(wanted, default) | {row.source: row.last_date for row in stored.collect()}


def rows_after(
    df: DataFrame, source: str, day: str, state: DataFrame, default: date, inclusive: bool = False
) -> DataFrame:
    """Rows of `df` after the last date of their source, or after the default."""
    # One row per source, however long the table of commits has grown.
    known = settle(state.select(F.col("source").alias("_source"), F.col("last_date").alias("_last")), "dates")
    joined = df.join(known, df[source] == F.col("_source"), "left")
    bound = F.coalesce("_last", F.lit(default))
    keep = F.col(day) >= bound if inclusive else F.col(day) > bound
    return joined.filter(keep).drop("_source", "_last")


def has_new(df: DataFrame, source: str, day: str, last: date) -> DataFrame:
    """`source, has_new`: whether a source has rows after the date."""
    newest = F.max(day) > F.lit(last)
    return df.groupBy(F.col(source).alias("source")).agg(F.coalesce(newest, F.lit(False)).alias("has_new"))


def advance(df: DataFrame, path: str, stage: str, source: str | Column, day: str) -> None:
    """Append the latest day of each source in `df`.

    Called after the data itself is written: a failure in between repeats a
    rewrite of the same partitions and loses nothing.
    """
    newest = df.groupBy((F.col(source) if isinstance(source, str) else source).alias("source")).agg(F.max(day).alias("last_date"))
    newest = newest.filter(F.col("last_date").isNotNull())
    newest = newest.select("source", F.lit(stage).alias("stage"), "last_date", F.current_timestamp().alias("committed_at"))
    append(newest.coalesce(1), path)  # one row per source


def compact(spark: SparkSession, path: str, files: int = 64) -> bool:
    """Replace the commits by the newest of each source and stage, if they lie in more than `files` files.

    The newest are added first and the older files deleted after, so a crash in
    between leaves commits twice, which changes nothing.
    """
    commits = scan_or_empty(spark, path, STATE)
    old = commits.inputFiles()
    if len(old) <= files:
        return False
    newest = F.struct("committed_at", "last_date")
    kept = commits.groupBy("source", "stage").agg(F.max(newest).alias("_newest"))
    kept = settle(kept.select("source", "stage", "_newest.last_date", "_newest.committed_at"), "state")
    append(kept.coalesce(1), path)
    for file in old:
        remove(spark, file)
    return True


def take_over(spark: SparkSession, path: str, stage: str, sources: Iterable[str], text_file: str) -> None:
    """Store the ISO date that a text file holds as the last date of each source."""
    dates = spark.read.text(text_file).select(text_day(F.trim("value")).alias("last_date"))
    named = dates.select(F.explode(F.array(*map(F.lit, sources))).alias("source"), "last_date")
    advance(named, path, stage, "source", "last_date")
