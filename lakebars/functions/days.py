"""Days, months and zones as column expressions.

A calendar day is fixed once, as a DATE in a named zone, and everything after
works on that DATE, so no result depends on the session time zone.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400


def day_of_instant(ts: Column, zone: str) -> Column:
    """Day of a zoned TIMESTAMP as seen in `zone`.

    `to_date` would use the session zone, so the shifted instant is cut to
    whole days by arithmetic.
    """
    shifted = F.unix_seconds(F.from_utc_timestamp(ts, zone))
    return F.date_from_unix_date(F.floor(shifted / SECONDS_PER_DAY).cast("int"))


def day_of_utc(ts: Column, zone: str) -> Column:
    """Day in `zone` of a TIMESTAMP_NTZ that holds UTC.

    The instant is put together from the fields of `ts`, to the second: a cast
    to TIMESTAMP would use the session zone, and `convert_timezone` is several
    times slower per row.
    """
    seconds = (
        F.unix_date(ts.cast("date")).cast("bigint") * SECONDS_PER_DAY
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )
    return day_of_instant(F.timestamp_seconds(seconds), zone)


def midnight(ts: Column) -> Column:
    """A TIMESTAMP_NTZ cut to the start of its day."""
    return ts.cast("date").cast("timestamp_ntz")


def year_month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def with_month_parts(df: DataFrame, day: str) -> DataFrame:
    """Add the partition columns `year` and `month` as text."""
    return df.withColumns(
        {
            "year": F.date_format(day, "yyyy"),
            "month": F.date_format(day, "MM"),
        }
    )


def day_text(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def text_day(text: Column) -> Column:
    """Text to DATE; text that is not a date gives null."""
    return F.try_to_date(text, "yyyy-MM-dd")


def after(day: str, last: date, inclusive: bool = False) -> Column:
    """Rows of a DATE column after the last date, or from it on."""
    bound = F.lit(last)
    return F.col(day) >= bound if inclusive else F.col(day) > bound


def after_midnight(ts: str, last: date, inclusive: bool = False) -> Column:
    """`after` for a TIMESTAMP_NTZ column.

    Compares the column itself with a midnight, so the filter reaches the file
    scan; a cast of the column to DATE would not.
    """
    first = last if inclusive else last + timedelta(days=1)
    return F.col(ts) >= F.lit(first).cast("timestamp_ntz")
