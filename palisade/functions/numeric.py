"""Numeric column expressions with the missing-value rules of the package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def col(name: str | Column) -> Column:
    """Column by exact name, so that flow headers such as ``Flow Bytes/s`` work."""
    if isinstance(name, Column):
        return name
    return F.col("`" + name.replace("`", "``") + "`")


def finite(value: str | Column) -> Column:
    """The value as a double, or null when it is null, NaN or infinite."""
    number = col(value).cast("double")
    return F.when(F.abs(number) < F.lit(INFINITY), number)


def is_infinite(value: str | Column) -> Column:
    number = col(value).cast("double")
    return F.coalesce(F.abs(number) == F.lit(INFINITY), F.lit(False))


def ratio_or_zero(part: str | Column, whole: str | Column) -> Column:
    """part / whole, 0 when undefined."""
    return F.coalesce(F.try_divide(col(part).cast("double"), col(whole).cast("double")), F.lit(0.0))


def zscore(value: str | Column, mean: str | Column, std: str | Column, floor: float = 0.0) -> Column:
    """Standard score; 0 when the deviation is null or not above ``floor``."""
    spread = col(std)
    return F.when(spread > floor, (col(value) - col(mean)) / spread).otherwise(F.lit(0.0))


def clip(value: str | Column, low: Column | float, high: Column | float) -> Column:
    number = col(value)
    low = low if isinstance(low, Column) else F.lit(low)
    high = high if isinstance(high, Column) else F.lit(high)
    return F.when(number.isNotNull(), F.least(F.greatest(number, low), high))


def min_max(value: str | Column, low: Column, high: Column, pad: float = 0.0) -> Column:
    """(value - low) / (high - low + pad); a zero range without pad counts as 1."""
    span = high - low + F.lit(pad)
    return (col(value) - low) / F.when(span == 0, F.lit(1.0)).otherwise(span)


def band(value: str | Column, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Name of the highest limit reached; limits may come in any order."""
    number = col(value)
    result = F.lit(otherwise)
    for limit, name in sorted(limits):
        result = F.when(number >= limit, F.lit(name)).otherwise(result)
    return result


def magnitude_slot(value: str | Column, per_octave: int = 16) -> Column:
    """Integer slot of a finite number, non-decreasing in the number itself.

    Slots are logarithmic, so they need no knowledge of the data's range: zero is
    slot 0, and every octave on either side is cut into ``per_octave`` slots.
    """
    number = col(value).cast("double")
    shift = 1100 * per_octave
    level = F.floor(F.log2(F.abs(number)) * F.lit(float(per_octave))).cast("long") + F.lit(shift)
    return F.when(number == 0, F.lit(0).cast("long")).when(number > 0, level).otherwise(-level)
