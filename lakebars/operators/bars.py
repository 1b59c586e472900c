"""First and last values of a group by time, whatever order rows arrive in."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars.functions.days import year_month
from lakebars.operators.scratch import settle


def _join(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join each row to its group; null keys match null keys.

    Rows meet groups by a 64-bit hash of the keys, since a join on one long
    probes about twice as fast as one on several null-safe keys. The keys
    themselves are compared as well, so groups that share a hash stay apart.
    """
    renamed = groups.withColumnsRenamed({key: f"_group_{key}" for key in keys})
    renamed = renamed.withColumn("_group_hash", F.xxhash64(*(f"_group_{key}" for key in keys)))
    hashed = rows.withColumn("_hash", F.xxhash64(*keys))
    same = reduce(and_, (F.col(key).eqNullSafe(F.col(f"_group_{key}")) for key in keys))
    # Written as a CASE, the comparison of the keys does not become part of the join key.
    met = (F.col("_hash") == F.col("_group_hash")) & (F.when(same, F.col("_hash")) == F.col("_group_hash"))
    return hashed.join(renamed, met, how).drop("_hash", "_group_hash", *(f"_group_{key}" for key in keys))


def open_close(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    open_col: str,
    close_col: str,
    tie: Sequence[str] = (),
    sums: dict[str, str] | None = None,
    scratch: str | None = None,
    places: bool = False,
) -> DataFrame:
    """One row per group: `start_open`, `end_close` and the sums asked for.

    With `places` also `first` and `last`, the time and tie columns of the two
    rows, null where a group has no time; groups can be merged by them.

    `sums` maps a result name to a column. A row without a time counts in the
    sums but is neither first nor last; a group of such rows has neither.

    When `ts` alone orders a group, this is a single hash aggregation with
    partial results before the shuffle. When several rows share a time, `tie`
    lists the columns that order them. A key of several columns would make
    Spark sort every row, so the group's first and last time are found by hash
    aggregation, and only rows at those two times are compared in full. For
    that, this call runs a job at once and writes a small table into `scratch`
    (see `settle`), which must be there for as long as the result is used.
    """
    sums = sums or {}
    if not tie:
        found = df.groupBy(*keys).agg(
            *(F.sum(column).alias(name) for name, column in sums.items()),
            F.min_by(open_col, ts).alias("start_open"),
            F.max_by(close_col, ts).alias("end_close"),
            *((F.min(ts).alias("_first"), F.max(ts).alias("_last")) if places else ()),
        )
        if not places:
            return found
        place = lambda name: F.when(F.col(f"_{name}").isNotNull(), F.struct(F.col(f"_{name}").alias(ts))).alias(name)
        return found.select(*keys, *sums, "start_open", "end_close", place("first"), place("last"))

    ends = settle(
        df.groupBy(*keys).agg(
            *(F.sum(column).alias(name) for name, column in sums.items()),
            F.min(ts).alias("_first"),
            F.max(ts).alias("_last"),
        ),
        "ends",
        scratch,
    )
    needed = df.select(*dict.fromkeys([*keys, ts, *tie, open_col, close_col]))
    at_ends = _join(needed, ends.select(*keys, "_first", "_last"), keys)
    order = F.struct(ts, *tie)
    found = (
        at_ends.filter((F.col(ts) == F.col("_first")) | (F.col(ts) == F.col("_last")))
        .groupBy(*keys)
        .agg(
            F.min_by(open_col, order).alias("start_open"),
            F.max_by(close_col, order).alias("end_close"),
            *((F.min(order).alias("first"), F.max(order).alias("last")) if places else ()),
        )
    )
    return _join(ends.drop("_first", "_last"), found, keys, "left")


def month_bars(
    df: DataFrame,
    source: Sequence[str],
    day: str,
    ts: str,
    open_col: str = "Open",
    close_col: str = "Close",
    volume: str = "Volume",
    tie: Sequence[str] = (),
    scratch: str | None = None,
) -> DataFrame:
    """One bar per source and month.

    `max_volume` is the month's total volume; the name is kept for its readers.
    Rows are grouped by the first day of the month, a plain DATE; the text
    form is made once per group.
    """
    rows = df.withColumn("_month", F.trunc(day, "month"))
    bars = open_close(
        rows, [*source, "_month"], ts, open_col, close_col, tie, {"max_volume": volume}, scratch
    )
    return _month_columns(bars, source)


def day_states(
    df: DataFrame,
    source: Sequence[str],
    day: str,
    ts: str,
    open_col: str = "Open",
    close_col: str = "Close",
    volume: str = "Volume",
    tie: Sequence[str] = (),
    scratch: str | None = None,
) -> DataFrame:
    """One row per source and day, of which `merged_bars` makes months: a day's rows are read once, not with every month."""
    states = open_close(df, [*source, day], ts, open_col, close_col, tie, {"volume": volume}, scratch, places=True)
    return states.select(*source, day, F.col("volume").cast("bigint").alias("volume"), "start_open", "end_close", "first", "last")


def day_state_schema(rows: T.StructType, source: Sequence[str], day: str, ts: str, open_col: str, close_col: str, tie: Sequence[str] = ()) -> T.StructType:
    """The columns of `day_states` of `rows`."""
    place = T.StructType([T.StructField(name, rows[name].dataType) for name in (ts, *tie)])
    fields = [
        *((name, rows[name].dataType) for name in (*source, day)),
        *(("volume", T.LongType()), ("start_open", rows[open_col].dataType), ("end_close", rows[close_col].dataType)),
        *(("first", place), ("last", place)),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


def merged_bars(states: DataFrame, source: Sequence[str], day: str) -> DataFrame:
    """`month_bars` of the rows that `states` were made of."""
    months = states.groupBy(*source, F.trunc(day, "month").alias("_month")).agg(
        F.sum("volume").alias("max_volume"),
        F.min_by("start_open", "first").alias("start_open"),
        F.max_by("end_close", "last").alias("end_close"),
    )
    return _month_columns(months, source)


def _month_columns(bars: DataFrame, source: Sequence[str]) -> DataFrame:
    return bars.select(
        *source,
        year_month(F.col("_month")).alias("year_month"),
        F.date_format("_month", "yyyy").alias("year"),
        F.date_format("_month", "MM").alias("month"),
        F.col("max_volume").cast("bigint").alias("max_volume"),
        "start_open",
        "end_close",
    )


def day_open_close(
    df: DataFrame,
    source: Sequence[str],
    day: str,
    ts: str,
    open_col: str = "Open",
    close_col: str = "Close",
    tie: Sequence[str] = (),
    scratch: str | None = None,
) -> DataFrame:
    """Every row with its day's `start_open` and `end_close`.

    A window over the day would shuffle all rows and put one source's day into
    one task. The days are aggregated instead, with partial results before the
    shuffle, and the small table is joined back. This call runs a job at once
    and writes that table into `scratch`, as `open_close` does.
    """
    days = settle(open_close(df, [*source, day], ts, open_col, close_col, tie, scratch=scratch), "days", scratch)
    return _join(df, days, [*source, day], "left")
