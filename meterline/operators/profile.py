"""Looking at a table: null counts and the first rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def null_profile(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of every column, 0 for an empty table."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])


def preview(df: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows, as asked for; print ``df.schema`` beside it."""
    return df.limit(rows)
