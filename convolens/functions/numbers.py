"""Ratios and rounding that give the same digits in every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_to(x: Column, places: int = 4) -> Column:
    """Half-up on the double itself; built-in round() works on its decimal text and differs on ties."""
    scale = float(10**places)
    return F.floor(x * scale + 0.5) / scale


def ratio(part: Column, whole: Column, places: int | None = 4) -> Column:
    """part / whole, 0 where the whole is not positive."""
    value = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    value = value if places is None else round_to(value, places)
    return F.when(whole > 0, value).otherwise(F.lit(0.0))


def growth(current: Column, previous: Column) -> Column:
    """Relative growth; from nothing, the current value itself."""
    rise = round_to((current - previous) / F.nullif(previous, F.lit(0.0)))
    return F.when(previous <= 0, F.when(current <= 0, F.lit(0.0)).otherwise(round_to(current))).otherwise(rise)
