"""Made-up market and weather files in the shapes the package reads."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

BAR_HEADER = "Open,High,Low,Close,Volume,Dividends,Stock Splits,date"
PULL_HEADER = "ts,index_name,Open,High,Low,Close,Volume,Dividends,Stock Splits"
HOUR_HEADER = "date,hour,temperature_2m,precipitation,cloudcover,windspeed_10m"


def day_bars(index: str, day: date, bars: int = 7) -> list[tuple[float, float, int]]:
    """(open, close, volume) of each bar; the first bar of a day has no volume."""
    base = 100.0 * (1 + len(index)) + (day.toordinal() % 97) + 0.25
    return [(base + n, base + n + 0.5, 0 if n == 0 else 400_000_000 + 1000 * n + day.day) for n in range(bars)]


def archive_bars(root: Path, index: str, day: date, offset: str = "-04:00", bars: int = 7) -> Path:
    file = root / index / f"{day:%Y}" / f"{day:%m}" / f"{index}_{day}.csv"
    file.parent.mkdir(parents=True, exist_ok=True)
    lines = [f"{o},{o + 1},{o - 1},{c},{v},0.0,0.0,{day} 00:00:00{offset}" for o, c, v in day_bars(index, day, bars)]
    file.write_text("\n".join([BAR_HEADER, *lines]) + "\n")
    return file


def pull_lines(index: str, day: date, bars: int = 7, utc_offset: int = -4) -> list[str]:
    start = datetime(day.year, day.month, day.day, 9, 30, tzinfo=timezone(timedelta(hours=utc_offset)))
    return [
        f"{(start + timedelta(hours=n)).isoformat(sep=' ')},{index},{o},{o + 1},{o - 1},{c},{v},0.0,0.0"
        for n, (o, c, v) in enumerate(day_bars(index, day, bars))
    ]


def write_pull(folder: Path, lines: list[str], name: str = "pull.csv") -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join([PULL_HEADER, *lines]) + "\n")
    return folder


def archive_hours(root: Path, day: date, values: list[tuple] | None) -> Path:
    """Values per hour, or None for a day whose cells are all empty."""
    file = root / f"{day:%Y}" / f"{day:%m}" / f"weather_{day}.csv"
    file.parent.mkdir(parents=True, exist_ok=True)
    cells = values if values is not None else [("", "", "", "")] * 24
    lines = [f"{day},{hour}," + ",".join(str(v) for v in row) for hour, row in enumerate(cells)]
    file.write_text("\n".join([HOUR_HEADER, *lines]) + "\n")
    return file


def weather_values(day: date) -> list[tuple]:
    return [(20.0 + (day.day * 7 + h) % 11 / 10, h % 3 / 10, float(h * 4), 5.5 + h % 5) for h in range(24)]


def write_documents(folder: Path, days: dict[date, list[tuple] | None], name: str = "docs.json") -> Path:
    folder.mkdir(parents=True, exist_ok=True)
    names = ("temperature_2m", "precipitation", "cloudcover", "windspeed_10m")
    lines = []
    for day, values in days.items():
        cells = values if values is not None else [(None,) * 4] * 24
        hourly = {name: [row[i] for row in cells] for i, name in enumerate(names)}
        lines.append(json.dumps({"date": str(day), "hourly": hourly}))
    (folder / name).write_text("\n".join(lines) + "\n")
    return folder


def month_of(bars_by_day: dict[date, list[tuple]]) -> tuple[int, float, float]:
    """(volume, first open, last close) over the days given."""
    ordered = [bar for day in sorted(bars_by_day) for bar in bars_by_day[day]]
    return sum(v for _, _, v in ordered), ordered[0][0], ordered[-1][1]
