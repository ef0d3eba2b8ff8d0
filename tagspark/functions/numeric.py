"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import DIFFICULTY_BINS


def not_nan(c: Column) -> Column:
    """NaN is a missing value."""
    return F.when(~F.isnan(c), c)


def sentinel_to_null(c: Column, invalid: float = -1) -> Column:
    return F.when(c != F.lit(invalid), c)


def parse_time_limit(c: Column) -> Column:
    """First number in the text as seconds; NULL when there is none."""
    number = F.regexp_extract(F.lower(F.trim(c)), r"([0-9]+\.?[0-9]*)", 1)
    return F.nullif(number, F.lit("")).try_cast("double")


def difficulty_bin(c: Column, bins: list[tuple[float, float, str]] = DIFFICULTY_BINS) -> Column:
    """Right-closed classes; outside of all of them the result is NULL."""
    out = F.lit(None).cast("string")
    for low, high, name in reversed(bins):
        out = F.when((c > low) & (c <= high), F.lit(name)).otherwise(out)
    return out


def standardise(c: Column, mean: Column, std: Column) -> Column:
    """Z-score; a constant column keeps a divisor of 1."""
    return (c - mean) / F.when(std > 0, std).otherwise(F.lit(1.0))


def pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole.cast("double"))
