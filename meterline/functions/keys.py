"""Surrogate keys: md5 over the text of one or more columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType


def _text(df: DataFrame, name: str) -> Column:
    value = F.col(name)
    if not isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
        return value.cast("string")
    # A whole number is written without a decimal part, as the warehouse does.
    whole = (F.rint(value) == value) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def surrogate_key(df: DataFrame, *names: str) -> Column:
    """md5 hex of the columns of ``df`` joined with '-'; a null counts as empty text."""
    return F.md5(F.concat_ws("-", *[F.coalesce(_text(df, n), F.lit("")) for n in names]))
