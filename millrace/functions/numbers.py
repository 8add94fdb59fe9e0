"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_currency(c: Column, thousands: str | None = None) -> Column:
    """Number in a money text, or null.

    Commas and currency marks are dropped and a point is a decimal point. With
    ``thousands='.'`` a point in front of exactly three digits is a group mark and dropped.
    """
    text = c.cast("string")
    if thousands == ".":
        text = F.regexp_replace(text, r"\.(?=\d{3}(\D|$))", "")
    elif thousands is not None and thousands != ",":
        raise ValueError(f"unknown thousands mark {thousands!r}")
    return F.regexp_replace(text, r"[^0-9.-]", "").try_cast("double")


def round_half_even(c: Column, places: int) -> Column:
    """Round as NumPy does: scale, nearest integer with ties to even, scale back."""
    scale = float(10**places)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def percent(part: Column, whole: Column, places: int | None = 2) -> Column:
    share = F.try_divide(part, whole) * F.lit(100.0)
    return share if places is None else round_half_even(share, places)
