"""Calendar names of a timestamp."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def month_name(at: Column | str) -> Column:
    """Full English month name."""
    return F.date_format(at, "MMMM")


def weekday_name(at: Column | str) -> Column:
    """Full English weekday name."""
    return F.date_format(at, "EEEE")
