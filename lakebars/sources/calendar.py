"""The days a source should have, and the ones it lacks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def days_due(starts: DataFrame, end: date, start: str = "last_date") -> DataFrame:
    """One row per source and day from its start date to `end`, both included.

    A source that starts after `end` has no days.
    """
    others = [name for name in starts.columns if name != start]
    return (
        starts.filter(F.col(start) <= F.lit(end))
        .select(*others, F.explode(F.sequence(F.col(start), F.lit(end))).alias("day"))
    )


def days_missing(due: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Days of `due` with no landed row. Landed rows shrink to distinct days first."""
    return due.join(landed.select(*keys, "day").distinct(), [*keys, "day"], "left_anti")
