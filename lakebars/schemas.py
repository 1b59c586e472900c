"""Declared schemas. No read in this package infers one."""

from __future__ import annotations

from datetime import date

from pyspark.sql import types as T

# Names, default dates and variables that results depend on.
INDEXES = ("dowjones", "nasdaq", "sp500")
WEATHER = "weather"
WEATHER_VARIABLES = ("temperature_2m", "precipitation", "cloudcover", "windspeed_10m")
WEATHER_MEANS = {
    "temperature_2m": "avg_temperature",
    "precipitation": "avg_precipitation",
    "cloudcover": "avg_cloudcover",
    "windspeed_10m": "avg_windspeed",
}
PROCESS_FROM = date(2024, 1, 1)
LOAD_MARKET_FROM = date(2023, 1, 1)
LOAD_WEATHER_FROM = date(2024, 7, 11)
EXCHANGE_ZONE = "America/New_York"

LOADED = "loaded"
PROCESSED = "processed"


TEXT, LONG, INT, DOUBLE = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
DAY, TS, TS_NTZ = T.DateType(), T.TimestampType(), T.TimestampNTZType()


def table(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_BAR = {
    "Open": DOUBLE,
    "High": DOUBLE,
    "Low": DOUBLE,
    "Close": DOUBLE,
    "Volume": LONG,
    "Dividends": DOUBLE,
    "Stock Splits": DOUBLE,
}
_MONTH_PARTS = {"year": TEXT, "month": TEXT}

# One CSV per index and day; `date` is the day's midnight with its UTC offset.
ARCHIVE_BAR = table({**_BAR, "date": TS})

# A pulled file keeps the time of each bar and names its index.
PULLED_BAR = table({"ts": TS, "index_name": TEXT, **_BAR})

# Bronze market table; the last four are its partition columns.
BRONZE_BAR = table({"ts": TS, **_BAR, "index_name": TEXT, **_MONTH_PARTS, "trade_date": DAY})
BRONZE_BAR_KEYS = ("index_name", "year", "month", "trade_date")

# The same by month: each landing of a day is kept, told apart by its number.
LANDING = "landing"
BRONZE_BAR_MONTHS = table({"ts": TS, **_BAR, "trade_date": DAY, LANDING: LONG, "index_name": TEXT, **_MONTH_PARTS})
BRONZE_BAR_MONTH_KEYS = ("index_name", "year", "month")

_HOUR = {"hour": INT, **dict.fromkeys(WEATHER_VARIABLES, DOUBLE)}

# One CSV per day.
ARCHIVE_HOUR = table({"date": DAY, **_HOUR})

# Bronze weather table; the last three are its partition columns.
BRONZE_HOUR = table({**_HOUR, **_MONTH_PARTS, "date": DAY})
BRONZE_HOUR_KEYS = ("year", "month", "date")

BRONZE_HOUR_MONTHS = table({"date": DAY, **_HOUR, LANDING: LONG, **_MONTH_PARTS})
BRONZE_HOUR_MONTH_KEYS = ("year", "month")

SILVER_BAR = table(
    {"max_volume": LONG, "start_open": DOUBLE, "end_close": DOUBLE, "index_name": TEXT, **_MONTH_PARTS}
)
SILVER_BAR_KEYS = ("index_name", "year", "month")

SILVER_DAY = table(
    {"year_month": TEXT, "date": DAY, **dict.fromkeys(WEATHER_MEANS.values(), DOUBLE), **_MONTH_PARTS}
)
SILVER_DAY_KEYS = ("year", "month")

# Rows a landing could not place, with the reason and the file they came from.
REJECT = table({"reason": TEXT, "line": TEXT, "file": TEXT, "landed_at": TS})

STATE = table({"source": TEXT, "stage": TEXT, "last_date": DAY, "committed_at": TS})


def document(variables: dict[str, T.DataType] | None = None) -> T.StructType:
    """Schema of one landed response: a day and one array per variable."""
    variables = variables or dict.fromkeys(WEATHER_VARIABLES, DOUBLE)
    hourly = table({name: T.ArrayType(kind) for name, kind in variables.items()})
    return table({"date": DAY, "hourly": hourly})
