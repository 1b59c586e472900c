"""What a feed is: where its tables lie and how bronze becomes silver."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebars import schemas
from lakebars.functions.days import with_month_parts
from lakebars.operators.bars import day_state_schema, day_states, merged_bars, month_bars
from lakebars.operators.means import daily_means


@dataclass(frozen=True)
class DayStates:
    """A table between bronze and silver: a few rows for each source and day, so that a month is merged from its days."""

    schema: T.StructType  # with the partition columns of silver
    of_rows: Callable[[DataFrame], DataFrame]  # bronze rows of whole days
    to_silver: Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Feed:
    sources: tuple[str, ...]
    bronze: str
    bronze_schema: T.StructType
    bronze_keys: tuple[str, ...]  # partition columns of bronze; `silver_keys` are among them
    day: str  # DATE column of bronze
    silver: str
    silver_keys: tuple[str, ...]  # partition columns of bronze too; hold `year` and `month`
    build: Callable[[DataFrame], DataFrame]
    default: date = schemas.PROCESS_FROM  # where a run by dates begins
    since: date | None = None  # days before it never become silver
    source_col: str | None = None  # None: the feed is a single source
    states: DayStates | None = None  # None: a month is rebuilt from its bronze rows

    @property
    def by_month(self) -> bool:
        """Whether bronze keeps every landing of a day, of which the newest counts."""
        return schemas.LANDING in self.bronze_schema.names

    def newest(self, bronze: DataFrame) -> DataFrame:
        """The rows of each day's newest landing.

        The days are aggregated with partial results and joined back, so that
        rows are moved only if the list of days is too large to broadcast.
        """
        return self.newest_landings(bronze).drop(schemas.LANDING) if self.by_month else bronze

    def newest_landings(self, bronze: DataFrame) -> DataFrame:
        """The same with the number of the landing, where bronze is kept by month."""
        days = bronze.groupBy(*self.day_keys).agg(F.max(schemas.LANDING).alias(schemas.LANDING))
        return bronze.join(days, [*self.day_keys, schemas.LANDING], "left_semi").select(*bronze.columns)

    @property
    def day_keys(self) -> list[str]:
        return [key for key in (self.source_col, self.day) if key]

    @property
    def days(self) -> str:
        """Where the day states lie."""
        return f"{self.silver}_days"

    def source(self) -> Column:
        return F.col(self.source_col) if self.source_col else F.lit(self.sources[0])


def market_silver(bars: DataFrame, tie: tuple[str, ...] = ()) -> DataFrame:
    """Monthly bars. Where several bars of an index share a time, `tie` orders them."""
    return month_bars(bars, ["index_name"], "trade_date", "ts", tie=tie).select(*schemas.SILVER_BAR.names)


def bar_states(schema: T.StructType, source: str, day: str, ts: str, columns: tuple[str, str, str], tie: tuple[str, ...], silver: tuple[str, ...]) -> DayStates:
    """Day states of bars in bronze of `schema`; `columns` are those of open, close and volume, `silver` what months keep."""
    open_col, close_col, volume = columns
    fields = day_state_schema(schema, [source], day, ts, open_col, close_col, tie)

    def of_rows(bars: DataFrame) -> DataFrame:
        return with_month_parts(day_states(bars, [source], day, ts, open_col, close_col, volume, tie), day)

    return DayStates(
        schema=T.StructType([*(field for field in fields if field.name != source), *(T.StructField(key, T.StringType()) for key in (source, "year", "month"))]),
        of_rows=of_rows,
        to_silver=lambda states: merged_bars(states, [source], day).select(*silver),
    )


def weather_silver(hours: DataFrame) -> DataFrame:
    means = daily_means(hours, schemas.WEATHER_MEANS)
    return with_month_parts(means, "date").select(*schemas.SILVER_DAY.names)


def market_feed(
    lake: str,
    sources: tuple[str, ...] = schemas.INDEXES,
    tie: tuple[str, ...] = (),
    since: date | None = None,
    by_month: bool = False,
) -> Feed:
    return Feed(
        sources=sources,
        bronze=f"{lake}/bronze/market_data",
        bronze_schema=schemas.BRONZE_BAR_MONTHS if by_month else schemas.BRONZE_BAR,
        bronze_keys=schemas.BRONZE_BAR_MONTH_KEYS if by_month else schemas.BRONZE_BAR_KEYS,
        day="trade_date",
        silver=f"{lake}/silver/market_data",
        silver_keys=schemas.SILVER_BAR_KEYS,
        build=partial(market_silver, tie=tie),
        default=since or schemas.PROCESS_FROM,
        since=since,
        source_col="index_name",
        states=bar_states(
            schemas.BRONZE_BAR, "index_name", "trade_date", "ts", ("Open", "Close", "Volume"), tuple(tie), tuple(schemas.SILVER_BAR.names)
        ),
    )


def weather_feed(lake: str, by_month: bool = False) -> Feed:
    return Feed(
        sources=(schemas.WEATHER,),
        bronze=f"{lake}/bronze/weather_data",
        bronze_schema=schemas.BRONZE_HOUR_MONTHS if by_month else schemas.BRONZE_HOUR,
        bronze_keys=schemas.BRONZE_HOUR_MONTH_KEYS if by_month else schemas.BRONZE_HOUR_KEYS,
        day="date",
        silver=f"{lake}/silver/weather_data",
        silver_keys=schemas.SILVER_DAY_KEYS,
        build=weather_silver,
        default=date.min,
        states=DayStates(schemas.SILVER_DAY, weather_silver, lambda days: days),
    )
