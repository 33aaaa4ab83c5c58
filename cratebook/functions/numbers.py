"""Column expressions on numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(name: str, places: int) -> Column:
    """``F.round`` of a column of doubles. That goes through a decimal for each value, here only
    where a value is so near a tie, or so large, that floating point might tell it wrongly."""
    value, unit = F.col(name), float(10**places)
    scaled = value * unit
    plain = (F.abs(scaled) < 1e9) & (F.abs(scaled - F.floor(scaled) - 0.5) > 1e-4)
    return F.when(plain, F.floor(scaled + 0.5) / unit).otherwise(F.round(value, places))
