"""The whole run: land both feeds, then build weather and market silver."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebars import schemas
from lakebars.operators import versions
from lakebars.operators.lake import commit_partitions
from lakebars.operators.scratch import settle
from lakebars.operators.state import advance, compact, starts
from lakebars.plans.feeds import Feed, market_feed, weather_feed
from lakebars.plans.incremental import rebuild_pending, rebuild_since
from lakebars.sources.calendar import days_due, days_missing
from lakebars.sources.landing import Landed, archived_bars, archived_hours, bronze_bars, bronze_hours
from lakebars.streaming.arrivals import process_arrivals

log = logging.getLogger(__name__)

MOST_LANDINGS = 32


@dataclass(frozen=True)
class RunConfig:
    lake: str
    market_pull: str | None = None  # directory of one pull of bars; none: nothing was pulled
    weather_pull: str | None = None  # directory of one pull of weather documents
    indexes: tuple[str, ...] = schemas.INDEXES
    zone: str = schemas.EXCHANGE_ZONE
    # Columns that order bars of one index and time, if times are not unique.
    bar_tie: tuple[str, ...] = ()
    # Days before it never become market silver.
    market_from: date | None = None
    # How silver is kept up to date: by what landings have "touched", from the
    # stored "dates" on, by the months of new files ("arrivals"), or in "full".
    market_by: str = "touched"
    weather_by: str = "touched"
    # One directory of bronze for each source and "day", or "month". By month a
    # landing adds files, and the newest landing of a day counts: some thirty
    # times fewer directories, for lakes of more than a few hundred sources.
    bronze_by: str = "day"
    # How long files that were replaced stay, for readers that began before.
    keep_seconds: float = versions.KEEP_SECONDS

    @property
    def state(self) -> str:
        return f"{self.lake}/state"

    def market(self) -> Feed:
        return market_feed(self.lake, self.indexes, self.bar_tie, self.market_from, self.bronze_by == "month")

    def weather(self) -> Feed:
        return weather_feed(self.lake, self.bronze_by == "month")

    def rejects(self, feed: str) -> str:
        return f"{self.lake}/rejects/{feed}"


def land(rows: DataFrame, feed: Feed, state: str, gather: bool = True) -> int:
    """Replace the days in `rows` in bronze, all at once; the number of rows.

    `rows` must come from files outside the lake. They are read once to count
    them by partition and once to be written, by those numbers. The commit that
    makes them count is also what tells silver which partitions they touch; the
    last day landed is stored at the end.
    """
    spark = rows.sparkSession
    counted = rows.groupBy(feed.source().alias("_source"), *feed.bronze_keys)
    counted = settle(counted.agg(F.max(feed.day).alias("_last"), F.count("*").alias("n")), "landing")
    count = counted.agg(F.sum("n")).first()[0]
    if not count:
        return 0
    if feed.by_month:
        # Numbers are given out by the lake: a later landing of a day stands above an earlier one, whatever the clocks say.
        number = versions.claim_number(spark, f"{feed.bronze}_landings")
        rows = rows.withColumn(schemas.LANDING, F.lit(number).cast("bigint")).select(*feed.bronze_schema.names)
    commit_partitions(
        rows, feed.bronze, feed.bronze_keys, replaces=not feed.by_month, gather=gather, sizes=counted, sort=[feed.day] if feed.by_month else ()
    )
    advance(counted, state, schemas.LOADED, "_source", "_last")
    return count


def compact_landings(spark: SparkSession, feed: Feed, most: int = MOST_LANDINGS) -> int:
    """Fold the landings of each month of bronze that more than `most` commits hold into one; how many months.

    Only the newest landing of each day is kept. A landing that comes between
    makes this a conflict, and the months are left for the next time.
    """
    now = versions.snapshot(spark, feed.bronze)
    if not feed.by_month or now is None:
        return 0
    many = {name for name, ids in now.live.items() if len(ids) > most}
    if not many:
        return 0
    rows = feed.newest_landings(versions.read(spark, feed.bronze, feed.bronze_schema, now, many))
    try:
        return commit_partitions(rows, feed.bronze, feed.bronze_keys, sort=[feed.day], base=now.number, same=True)
    except versions.Conflict as conflict:
        log.info("left for later: %s", conflict)
        return 0


def _land(landed: Landed, feed: Feed, config: RunConfig, name: str, kind: str = "pull") -> tuple[int, int]:
    """Rows landed and rows rejected; rejects are kept, never dropped."""
    rejected = landed.rejects.count()
    if rejected:
        log.warning("%d rows of the %s %s were rejected, see %s", rejected, name, kind, config.rejects(name))
        versions.append(landed.rejects, config.rejects(name))
    # Archive files hold one day each, so no row of theirs is moved.
    return land(landed.rows, feed, config.state, gather=kind == "pull"), rejected


def land_market(spark: SparkSession, config: RunConfig) -> tuple[int, int]:
    """Rows landed and rejected; bars of an index that is not configured are rejected as well."""
    if config.market_pull is None:
        return 0, 0
    landed = bronze_bars(spark, config.market_pull, config.zone, config.bar_tie)
    known = F.col("index_name").isin(list(config.indexes))
    strange = landed.rows.filter(~known).select(
        F.lit("unknown index").alias("reason"),
        F.to_json(F.struct(*schemas.PULLED_BAR.names)).alias("line"),
        F.lit(None).cast("string").alias("file"),
        F.current_timestamp().alias("landed_at"),
    )
    landed = Landed(landed.rows.filter(known), landed.rejects.unionByName(strange))
    return _land(landed, config.market(), config, "market")


def land_weather(spark: SparkSession, config: RunConfig) -> tuple[int, int]:
    if config.weather_pull is None:
        return 0, 0
    return _land(bronze_hours(spark, config.weather_pull), config.weather(), config, "weather")


def take_over_archives(
    spark: SparkSession, config: RunConfig, market_root: str | None = None, weather_root: str | None = None
) -> dict[str, int]:
    """Bring daily CSV archives into bronze; rows taken over, and as `reject_<feed>` rows rejected, if there are any."""
    found = {}
    if market_root:
        landed = archived_bars(spark, market_root, config.indexes, config.zone)
        found["market"] = _land(landed, config.market(), config, "market", "archive")
    if weather_root:
        found["weather"] = _land(archived_hours(spark, weather_root), config.weather(), config, "weather", "archive")
    rejected = {f"reject_{name}": bad for name, (_, bad) in found.items() if bad}
    return {name: rows for name, (rows, _) in found.items()} | rejected


def days_to_pull(spark: SparkSession, config: RunConfig, feed: Feed, default: date, end: date) -> DataFrame:
    """`source, day`: from each source's last loaded day, included, to `end`."""
    since = starts(spark, config.state, schemas.LOADED, feed.sources, default)
    return days_due(spark.createDataFrame(list(since.items()), "source string, last_date date"), end)


def holes(spark: SparkSession, feed: Feed, bronze: DataFrame, start: date, end: date) -> DataFrame:
    """`source, day` from `start` to `end` with nothing landed."""
    wanted = spark.createDataFrame([(source, start) for source in feed.sources], "source string, last_date date")
    landed = bronze.select(feed.source().alias("source"), F.col(feed.day).alias("day"))
    return days_missing(days_due(wanted, end), landed, ["source"])


def build_silver(spark: SparkSession, config: RunConfig, feed: Feed, by: str) -> int:
    """The number of silver partitions rebuilt."""
    if by == "touched":
        return rebuild_pending(spark, feed, config.state)
    if by == "arrivals":
        # The checkpoint belongs to the silver table it has filled.
        return process_arrivals(spark, feed, f"{feed.silver}_arrivals")
    if by not in ("dates", "full"):
        raise ValueError(f"unknown way to build silver: {by}")
    return rebuild_since(spark, feed, config.state, full=by == "full")


def run(spark: SparkSession, config: RunConfig, raise_on_error: bool = False) -> dict[str, int | Exception]:
    """Run all steps; a step that fails is logged and the others still run.

    Returns counts: rows landed and rejected, silver partitions rebuilt, or the
    error a step ended with. With `raise_on_error` the errors are raised
    together after the last step, so that a scheduler sees them.
    """
    steps: dict[str, Callable[[], int | tuple[int, int]]] = {
        "market": lambda: land_market(spark, config),
        "weather": lambda: land_weather(spark, config),
        "weather_silver": lambda: build_silver(spark, config, config.weather(), config.weather_by),
        "market_silver": lambda: build_silver(spark, config, config.market(), config.market_by),
    }
    outcome: dict[str, int | Exception] = {}
    for name, step in steps.items():
        landing = not name.endswith("_silver")
        try:
            found = step()
            outcome |= {f"land_{name}": found[0], f"reject_{name}": found[1]} if landing else {name: found}
        except Exception as error:  # one feed must not stop the other
            log.exception("step %s failed", name)
            outcome[f"land_{name}" if landing else name] = error
    compact(spark, config.state)
    for feed in (config.market(), config.weather()):
        compact_landings(spark, feed)
        for path in (feed.bronze, feed.days, feed.silver):
            versions.vacuum(spark, path, config.keep_seconds)
    errors = [error for error in outcome.values() if isinstance(error, Exception)]
    if errors and raise_on_error:
        raise ExceptionGroup("steps of the run failed", errors)
    return outcome
