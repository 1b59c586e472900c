"""Daily means."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebars.functions.days import year_month
from lakebars.functions.means import mean_parts, rounded_mean


def daily_means(
    df: DataFrame, means: dict[str, str], day: str = "date", digits: int = 2, nan_as_missing: bool = False
) -> DataFrame:
    """One row per day with the rounded mean of each column in `means`.

    `means` maps a column to its result name. Nulls are ignored; a day with
    nothing but nulls keeps its row. NaN makes the day's mean NaN, unless it
    counts as missing. Values of up to 18 decimals and below 10^17 are exact;
    a larger one is an error.
    """
    parts = [part for column, name in means.items() for part in mean_parts(F.col(column), name)]
    return (
        df.select(F.col(day).alias("date"), *means)
        .groupBy("date")
        .agg(*parts)
        .select(
            year_month(F.col("date")).alias("year_month"),
            "date",
            *(rounded_mean(name, digits, nan_as_missing) for name in means.values()),
        )
    )
