"""Clean trips -> staging rows: calendar columns, one row per group of equal keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..functions import month_name, weekday_name
from ..schemas import (
    COORDINATES,
    ID_COLUMNS,
    MEASURES,
    SERVICES,
    STAGING,
    TIME_COLUMNS,
)


def add_calendar(df: DataFrame, at: str = "pickup_datetime") -> DataFrame:
    """Year, month name and weekday name of a timestamp column."""
    return df.withColumns({"year": F.year(at), "month": month_name(at), "dow": weekday_name(at)})


def tag_service(df: DataFrame, service: str) -> DataFrame:
    """Constant service code of the source the rows came from."""
    return df.withColumn("service_type", F.lit(SERVICES[service]))


def union_services(*frames: DataFrame) -> DataFrame:
    """All rows of all services, matched by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def staging_input(df: DataFrame, *also: str) -> DataFrame:
    """Only what staging needs, under warehouse names and types."""
    return df.select(
        *[F.col(old).cast(kind).alias(new) for old, (new, kind) in ID_COLUMNS.items()],
        *[F.col(name).cast("timestamp_ntz").alias(name) for name in TIME_COLUMNS],
        *[F.col(name).cast("double").alias(name) for name in COORDINATES + MEASURES],
        *also,
    )


def grouped_sums(df: DataFrame, *also: str) -> DataFrame:
    """Sums of the ten measures per group of equal keys.

    The calendar columns follow from the pickup time, so they are derived after the
    grouping: the groups are the same, and two texts and a number per row need not be
    hashed, shuffled and compared.
    """
    return add_calendar(partial_sums(df, *also))


def partial_sums(df: DataFrame, *also: str) -> DataFrame:
    """The groups of ``grouped_sums`` without the columns that follow from the keys.

    Sums of parts can be stored and summed again: ``staging_rows`` of the parts' sums is
    ``staging_rows`` of all their rows.
    """
    keys = [new for new, _ in ID_COLUMNS.values()] + [*TIME_COLUMNS, *COORDINATES, *also]
    return df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in MEASURES])


def staging_rows(rows: DataFrame, *also: str) -> DataFrame:
    """Rows of ``staging_input`` -> the 25 staging columns (and ``also``)."""
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in STAGING.fields]
    return grouped_sums(rows, "service_type", *also).select(*columns, *also)


def build_staging(df: DataFrame, *also: str) -> DataFrame:
    """Clean trips with ``service_type`` -> staging rows.

    Equal keys of one service meet in one row, whatever file they came from. ``also``
    names further key columns, such as the batch the rows belong to.
    """
    return staging_rows(staging_input(df, "service_type", *also), *also)
