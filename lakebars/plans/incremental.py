"""Rebuild the silver months that new bronze rows touch.

Each table follows the log of commits of the one before it (`versions`), and
notes in its own commits how far it has got. With day states a landing is taken
in by two steps: the rows of the touched days become day states, then the days
of the touched months become silver. Without them a touched month is rebuilt
from all its bronze rows. Either way a late day, a day landed again, a repeated
run, a crash between any two steps or two runs at once end in the same table as
one full run.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars import schemas
from lakebars.operators import versions
from lakebars.operators.lake import commit_small_partitions, distinct_keys, partition_name, read_partitions
from lakebars.operators.scratch import settle
from lakebars.operators.state import advance, starts
from lakebars.plans.feeds import Feed
from lakebars.sources.files import empty

log = logging.getLogger(__name__)

# How often a run begins anew because another one came between.
ATTEMPTS = 20


def _again(run: Callable[[], int]) -> int:
    for attempt in range(ATTEMPTS):
        try:
            return run()
        except versions.Conflict as conflict:
            log.info("begin anew: %s", conflict)
            if attempt == ATTEMPTS - 1:
                raise
    raise AssertionError


def _wanted(rows: DataFrame, feed: Feed) -> DataFrame:
    rows = feed.newest(rows.filter(feed.source().isin(list(feed.sources))))
    return rows if feed.since is None else rows.filter(F.col(feed.day) >= F.lit(feed.since))


def configured(spark: SparkSession, feed: Feed) -> DataFrame:
    """Bronze rows of the feed's own sources, from its first day on."""
    return _wanted(read_partitions(spark, feed.bronze, feed.bronze_schema), feed)


def _values(name: str) -> dict[str, str]:
    """The keys and values in the name of a partition directory."""
    return {key: unquote(value) for key, value in (part.split("=", 1) for part in name.split("/"))}


def _own(names: Iterable[str], feed: Feed) -> set[str]:
    """Those of the feed's own sources, and those that hold all sources together."""
    if feed.source_col is None:
        return set(names)
    own = {partition_name(feed.source_col, source) for source in feed.sources}
    other = f"{feed.source_col}="
    return {name for name in names if not any(part.startswith(other) and part not in own for part in name.split("/"))}


def _silver_names(names: Iterable[str], feed: Feed) -> set[str]:
    """The silver partitions that partitions of bronze, or of its states, belong to."""
    found = set()
    for name in names:
        parts = dict(part.split("=", 1) for part in name.split("/"))
        found.add("/".join(f"{key}={parts[key]}" for key in feed.silver_keys))
    return found


def _of_months(spark: SparkSession, feed: Feed, months: set[str]) -> DataFrame:
    """All bronze rows of silver partitions; no other directory is listed."""
    now = versions.snapshot(spark, feed.bronze) or versions.Snapshot()
    wanted = {name for name in now.live if _silver_names([name], feed) <= months}
    return _wanted(versions.read(spark, feed.bronze, feed.bronze_schema, now, wanted), feed)


def _touched_days(spark: SparkSession, feed: Feed, after: int, names: set[str]) -> DataFrame:
    """`feed.day_keys` of the days that landings beyond the number `after` hold."""
    if feed.day in feed.bronze_keys:
        named = [_values(name) for name in sorted(names)]
        days = spark.createDataFrame([tuple(values[key] for key in feed.day_keys) for values in named], ", ".join(f"`{key}` string" for key in feed.day_keys))
        return days.withColumn(feed.day, F.col(feed.day).cast("date"))
    now, found = versions.snapshot(spark, feed.bronze), versions.entries(spark, feed.bronze, after)
    for name in names & now.live.keys() if found is not None else ():
        landed = {entry["id"] for entry in found if not entry["same"] and name in entry["partitions"]}
        if landed <= set(now.live[name]):  # only the files of these landings, unless some were compacted since
            now.live[name] = [one for one in now.live[name] if one in landed]
    rows = versions.read(spark, feed.bronze, feed.bronze_schema, now, names & now.live.keys())
    return settle(rows.select(*feed.day_keys).distinct(), "touched-days")


def rows_pending(spark: SparkSession, feed: Feed) -> DataFrame:
    """All bronze rows of the days that landings touched and the day states have not taken in; only those days are read."""
    now = versions.snapshot(spark, feed.days) or versions.Snapshot()
    names = _own(versions.changed(spark, feed.bronze, now.taken)[0], feed)
    if not names:
        return empty(spark, feed.bronze_schema)
    return _rows_of_days(spark, feed, names, _touched_days(spark, feed, now.taken, names))


def _rows_of_days(spark: SparkSession, feed: Feed, names: set[str], days: DataFrame) -> DataFrame:
    now = versions.snapshot(spark, feed.bronze)
    rows = versions.read(spark, feed.bronze, feed.bronze_schema, now, names)
    if feed.day not in feed.bronze_keys:
        rows = rows.join(days, feed.day_keys, "left_semi")
    return _wanted(rows, feed)


def _take_in_days(spark: SparkSession, feed: Feed) -> None:
    """Bring the day states up to the last landing: states of touched days are made anew, the others of their months stay."""
    now = versions.snapshot(spark, feed.days) or versions.Snapshot()
    names, upto = versions.changed(spark, feed.bronze, now.taken)
    names = _own(names, feed)
    if not names:
        return
    days = _touched_days(spark, feed, now.taken, names)
    made = feed.states.of_rows(_rows_of_days(spark, feed, names, days)).select(*feed.states.schema.names)
    months = _silver_names(names, feed)
    kept = versions.read(spark, feed.days, feed.states.schema, now, months & now.live.keys())
    kept = kept.join(days, [kept[key].eqNullSafe(days[key]) for key in feed.day_keys], "left_anti")
    commit_small_partitions(kept.unionByName(made), feed.days, feed.silver_keys, gone=months, taken=upto, base=now.number)


def _take_in_months(spark: SparkSession, feed: Feed, state: str) -> int:
    now = versions.snapshot(spark, feed.silver) or versions.Snapshot()
    source = feed.days if feed.states else feed.bronze
    names, upto = versions.changed(spark, source, now.taken)
    months = _silver_names(_own(names, feed), feed)
    if not months:
        return 0
    if feed.states:
        at = versions.snapshot(spark, source)
        rows = versions.read(spark, source, feed.states.schema, at, months & at.live.keys())
        silver = feed.states.to_silver(rows)
    else:
        rows = _of_months(spark, feed, months)
        silver = feed.build(rows)
    rebuilt = commit_small_partitions(silver, feed.silver, feed.silver_keys, gone=months, taken=upto, base=now.number)
    advance(rows, state, schemas.PROCESSED, feed.source(), feed.day)
    return rebuilt


def rebuild_pending(spark: SparkSession, feed: Feed, state: str) -> int:
    """Bring silver up to date with all landings since the last time; the number of partitions rebuilt.

    What a landing touched is in the log of bronze, so late days, old days and
    days landed again are all seen, and nothing has to be searched.
    """
    if feed.states:
        _again(lambda: _take_in_days(spark, feed) or 0)
    return _again(lambda: _take_in_months(spark, feed, state))


def rows_due(spark: SparkSession, feed: Feed, state: str) -> DataFrame:
    """All bronze rows of the months from each source's last date on.

    The last date's own month is included, so a day re-landed with more rows
    is seen. The bounds are constants on partition columns, grouped by month,
    so older directories are skipped before any file is opened and no join is
    needed. Where silver partitions hold all sources together, they share the
    earliest month, since a partition is always rebuilt as a whole.
    """
    since = starts(spark, state, schemas.PROCESSED, feed.sources, feed.default)
    if feed.source_col not in feed.silver_keys:
        since = dict.fromkeys(since, min(since.values()))
    by_month: dict[str, list[str]] = {}
    for source, last in since.items():
        by_month.setdefault(last.isoformat()[:7], []).append(source)
    month = F.concat_ws("-", "year", "month")
    bounds = [feed.source().isin(sources) & (month >= first) for first, sources in by_month.items()]
    bronze = read_partitions(spark, feed.bronze, feed.bronze_schema)
    return _wanted(bronze.filter(reduce(or_, bounds)), feed)


def _replace_silver(spark: SparkSession, feed: Feed, rows_of: Callable[[], DataFrame | None]) -> tuple[int, DataFrame | None]:
    """Build and replace the silver partitions of rows; anew if they were replaced since the rows were chosen."""
    chosen: list[DataFrame | None] = []

    def build() -> int:
        base = versions.snapshot(spark, feed.silver) or versions.Snapshot()
        chosen.append(rows_of())
        if chosen[-1] is None:
            return 0
        return commit_small_partitions(feed.build(chosen[-1]), feed.silver, feed.silver_keys, base=base.number)

    rebuilt = _again(build)
    return rebuilt, chosen[-1]


def rebuild_since(spark: SparkSession, feed: Feed, state: str, full: bool = False) -> int:
    """Rebuild silver from each source's stored date on, or all of it; the number of partitions rebuilt.

    Days older than the stored date's month that arrive late are seen by a full
    rebuild or by `rebuild_pending`, not by this. The state is appended after
    the write, from the same listing of bronze files; bronze is read once to
    build silver and, the day column alone, once more for the state.
    """
    rebuilt, due = _replace_silver(spark, feed, lambda: configured(spark, feed) if full else rows_due(spark, feed, state))
    if rebuilt:
        advance(due, state, schemas.PROCESSED, feed.source(), feed.day)
    return rebuilt


def rows_touched(spark: SparkSession, feed: Feed, touched: DataFrame) -> DataFrame | None:
    """All bronze rows of the silver partitions that rows of `touched` belong to, found by a join.

    The list of partitions is written first so that Spark joins by its true
    size; the year bound prunes bronze by a constant and lets the join prune
    the months at run time.
    """
    months = settle(distinct_keys(touched, feed.silver_keys), "touched")
    first = months.agg(F.min("year")).first()[0]
    if first is None:
        return None
    recent = months.filter(F.col("year") >= first)
    bronze = read_partitions(spark, feed.bronze, feed.bronze_schema)
    return _wanted(bronze.join(recent, list(feed.silver_keys), "left_semi"), feed)


def rebuild_touched(spark: SparkSession, feed: Feed, touched: DataFrame) -> int:
    return _replace_silver(spark, feed, lambda: rows_touched(spark, feed, touched))[0]


def rebuild_named(spark: SparkSession, feed: Feed, names: Iterable[str]) -> int:
    """Rebuild the silver partitions that partitions of bronze belong to; how many they are."""
    months = _silver_names(_own(names, feed), feed)
    return _replace_silver(spark, feed, lambda: _of_months(spark, feed, months))[0] if months else 0
