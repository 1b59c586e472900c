"""Means that do not depend on the order rows arrive in.

A double sum changes with the order of its terms, enough to move a mean that
lies on a rounding tie. These sums are exact and held in parts, none of which
10^11 rows can overflow. A value of at most six decimals is kept as a whole
number of 10^-6 units, a plain long inside the hash aggregation, its high and low
bits summed apart. Only values that are larger or have more decimals are summed
as decimals, before and behind the point apart, which is several times slower.
What one part carries over to another is settled once for each result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE = 6
_UNIT = float(10**SCALE)
_LOW_BITS = 25
_FINE = "decimal(38,18)"
_BEHIND = "decimal(20,18)"


def mean_parts(value: Column, name: str) -> list[Column]:
    """Aggregates that `rounded_mean` turns into a mean."""
    value = value.cast("double")
    scaled = F.rint(value * _UNIT)
    # Whole units that give back the very same double.
    plain = (F.abs(scaled) < float(1 << 2 * _LOW_BITS)) & (scaled / _UNIT == value)
    units = F.when(plain, scaled.cast("bigint"))
    # Infinite values are too large as well; NaN is counted apart.
    beyond = F.raise_error(F.concat(F.lit(f"{name}: a value is too large for an exact mean: "), value.cast("string")))
    fine = F.when(F.abs(value) < 1e17, value.cast(_FINE)).otherwise(beyond.cast(_FINE))
    fine = F.when(~plain & ~F.isnan(value), fine)
    return [
        F.sum(F.shiftright(units, _LOW_BITS)).alias(f"_{name}_high"),
        F.sum(units.bitwiseAND(F.lit((1 << _LOW_BITS) - 1).cast("bigint"))).alias(f"_{name}_low"),
        F.sum(fine.cast("bigint").cast("decimal(20,0)")).alias(f"_{name}_whole"),
        F.sum((fine % Decimal(1)).cast(_BEHIND)).alias(f"_{name}_behind"),
        F.count(F.when(value.isNotNull() & ~F.isnan(value), True)).alias(f"_{name}_n"),
        F.count(F.when(F.isnan(value), True)).alias(f"_{name}_nan"),
    ]


def rounded_mean(name: str, digits: int = 2, nan_as_missing: bool = False) -> Column:
    """The mean rounded half away from zero; null when there were no values.

    As with `avg`, NaN among the values makes the mean NaN, unless it counts as
    missing. `digits` is at most 6.
    """
    wide = "decimal(38,0)"
    high, low, whole, behind = (F.coalesce(F.col(f"_{name}_{part}"), F.lit(0)) for part in ("high", "low", "whole", "behind"))
    n, nan = F.col(f"_{name}_n"), F.col(f"_{name}_nan")
    count = F.nullif(n, F.lit(0)).cast("decimal(19,0)")
    units = (high.cast("decimal(20,0)") * F.lit(Decimal(1 << _LOW_BITS)) + low).cast("decimal(30,0)")
    plain = units * F.lit(Decimal(1).scaleb(-SCALE))
    behind = behind.cast("decimal(30,18)")
    # The sum as a whole number and a part from 0 to below 1, first of the three sums, then of its absolute value.
    part = (plain - F.floor(plain)).cast(_BEHIND) + (behind - F.floor(behind)).cast(_BEHIND)
    total = (whole.cast("decimal(30,0)") + F.floor(plain) + F.floor(behind) + F.floor(part)).cast(wide)
    part = (part - F.floor(part)).cast(_BEHIND)
    negative = total < 0
    left = F.when(negative, -total - F.when(part > 0, 1).otherwise(0)).otherwise(total).cast(wide)
    part = F.when(negative & (part > 0), Decimal(1) - part).otherwise(part).cast(_BEHIND)
    # Whole means first; of what is left, round(x / n) is (2x + n) div 2n, and the part of x behind the point cannot change it.
    rest = ((left % count).cast("decimal(19,0)") + part).cast("decimal(31,18)")
    doubled = F.floor(rest * F.lit(Decimal(2 * 10**digits))) + count
    div = lambda x, y: F.call_function("div", x, y).cast("decimal(20,0)")
    rounded = div(left, count) * F.lit(Decimal(10**digits)) + div(doubled, count * F.lit(Decimal(2)))
    # The sign goes to the whole number, which has no negative zero.
    signed = F.when(negative, -rounded).otherwise(rounded).cast("double") / F.lit(float(10**digits))
    if nan_as_missing:
        return signed.alias(name)
    return F.when(nan > 0, F.lit(float("nan"))).otherwise(signed).alias(name)
