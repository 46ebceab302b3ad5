"""Tolerant numeric parsing and exact percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decimal_text(c: Column) -> Column:
    """Decimal comma or point to double; anything else is null."""
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def number_or_null(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def count_or_zero(c: Column) -> Column:
    return F.coalesce(F.trim(c).try_cast("double").cast("bigint"), F.lit(0).cast("bigint"))


def percent(part: Column, whole: Column) -> Column:
    """Percentage of two counts with two decimals, half up, without float error.

    Whole-number arithmetic: round(100 * part / whole, 2) for non-negative counts;
    an empty whole gives 0.
    """
    part, whole = part.cast("bigint"), whole.cast("bigint")
    twice = part * 20000 + whole
    hundredths = (twice - twice % (whole * 2)) / (whole * 2)
    return F.when(whole > 0, hundredths / F.lit(100.0)).otherwise(F.lit(0.0))


def share(part: Column, whole: Column) -> Column:
    """Plain ratio; null when there is nothing to divide by."""
    return part / F.nullif(whole, F.lit(0))
