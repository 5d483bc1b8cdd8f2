"""Inner lookup joins that broadcast only what has been measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DatetimeType,
    MapType,
    NumericType,
    StructType,
    VariantType,
)

# What a lookup may take in the memory of every executor, in rows and in bytes.
BROADCAST_ROWS = 500_000
BROADCAST_BYTES = 50_000_000


def row_bytes(df: DataFrame) -> Column:
    """About what a row takes in memory: 8 bytes a column and its texts and nested values."""
    size = F.lit(8 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType, VariantType)):
            value = F.to_json(F.struct(value))
        if not isinstance(field.dataType, (NumericType, BooleanType, DatetimeType)):
            size = size + F.coalesce(F.octet_length(value), F.lit(0))
    return size


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes.

    One aggregation, not a limited collect: each task returns two numbers, and where no
    column is of varying width the count is answered from Parquet footers.
    """
    rows, size = df.agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(
    left: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    *,
    small: bool | None = None,
) -> DataFrame:
    """Inner equi-join of a large frame with a lookup.

    ``small`` says whether the lookup's size has been checked already; None checks it
    here. A small lookup is broadcast, so the large side is not shuffled and a hot
    key costs nothing. A lookup beyond the bound takes a plain shuffled join, in which
    adaptive execution splits the partitions of hot keys; each side is read once.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if small is None:
        small = fits_broadcast(lookup)
    if small:
        return left.join(F.broadcast(lookup), keys, "inner")
    return left.join(lookup, keys, "inner")
