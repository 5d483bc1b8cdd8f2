"""Raw monthly trips -> clean trips with the coordinates of both zones."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType

from .joins import fits_broadcast, lookup_join

log = logging.getLogger(__name__)

# Column names of the two raw services and of the clean trips.
RENAMES = {
    "green": {
        "lpep_pickup_datetime": "pickup_datetime",
        "lpep_dropoff_datetime": "dropoff_datetime",
        "ehail_fee": "fee",
    },
    "yellow": {
        "tpep_pickup_datetime": "pickup_datetime",
        "tpep_dropoff_datetime": "dropoff_datetime",
        "Airport_fee": "fee",
    },
}
DROPPED = {"green": ("trip_type", "fee"), "yellow": ("fee",)}
INTEGER_IDS = ("payment_type", "DOLocationID", "PULocationID", "VendorID")
ROLES = {"pickup": "PULocationID", "dropoff": "DOLocationID"}


def drop_if_present(df: DataFrame, name: str = "store_and_fwd_flag") -> DataFrame:
    """Drop a column that only some inputs have."""
    found = name.lower() in {c.lower() for c in df.columns}
    log.info("column %s %s", name, "dropped" if found else "not in the input")
    return df.drop(name)


def rename_service_columns(df: DataFrame, service: str) -> DataFrame:
    """Give the columns of one service their common names."""
    return df.withColumnsRenamed(RENAMES[service])


def drop_service_columns(df: DataFrame, service: str) -> DataFrame:
    """Drop the columns only one service has, and the fee of either."""
    return df.drop(*DROPPED[service])


def cast_ids(df: DataFrame) -> DataFrame:
    """Ids as int; a value that is no int becomes null instead of failing the job."""
    return df.withColumns({name: F.col(name).try_cast("int") for name in INTEGER_IDS})


def complete_rows(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Rows without null and without NaN in any column (or in the given ones).

    One condition per column, so the not-null tests reach the Parquet scan.
    """
    names = df.columns if columns is None else list(columns)
    conditions = [_has_value(name, df.schema[name].dataType) for name in names]
    return df.where(reduce(and_, conditions)) if conditions else df


def _has_value(name: str, kind) -> Column:
    value = F.col(f"`{name}`")
    if isinstance(kind, (FloatType, DoubleType)):
        return value.isNotNull() & ~F.isnan(value)
    return value.isNotNull()


def canonical_columns(df: DataFrame) -> DataFrame:
    """Columns in code-point order (capitals first)."""
    return df.select(*[f"`{name}`" for name in sorted(df.columns)])


def zone_role(zones: DataFrame, role: str) -> DataFrame:
    """The lookup reduced to one role: location id and the role's coordinates."""
    return zones.select(
        F.col("LocationID").alias("__zone"),
        F.col("latitude").alias(f"{role}_latitude"),
        F.col("longitude").alias(f"{role}_longitude"),
    )


def add_zone(
    df: DataFrame, zones: DataFrame, role: str, *, small: bool | None = None
) -> DataFrame:
    """Join the coordinates of the pickup or dropoff zone; trips without a zone go.

    Does nothing where the coordinates are there already.
    """
    if f"{role}_latitude" in df.columns:
        return df
    location = F.col(ROLES[role])
    if isinstance(df.schema[ROLES[role]].dataType, StringType):
        location = location.try_cast("bigint")
    keyed = df.withColumn("__zone", location)
    return lookup_join(keyed, zone_role(zones, role), "__zone", small=small).drop("__zone")


def clean_trips(
    df: DataFrame,
    zones: DataFrame,
    service: str,
    *,
    small: bool | None = None,
    watch: Callable[[DataFrame, str], DataFrame] | None = None,
) -> DataFrame:
    """Raw trips of one service -> complete, enriched rows in canonical column order.

    Incomplete rows leave before the joins and zones without coordinates leave the
    lookup: the same rows remain as when filtering last, and less is read and joined.
    ``watch`` gets the rows between the rules (see ``CleaningCounts``). The not-null tests
    then stay above the scan, as rows that they would skip there could not be counted.
    """
    if small is None:
        small = fits_broadcast(zones)
    located = complete_rows(zones, ("latitude", "longitude"))
    watch = watch or (lambda rows, _: rows)
    return (
        drop_if_present(df)
        .transform(rename_service_columns, service)
        .transform(drop_service_columns, service)
        .transform(watch, "read")
        .transform(complete_rows)
        .transform(watch, "complete")
        .transform(add_zone, located, "pickup", small=small)
        .transform(add_zone, located, "dropoff", small=small)
        .transform(watch, "located")
        .transform(cast_ids)
        .transform(complete_rows, INTEGER_IDS)
        .transform(canonical_columns)
        .transform(watch, "written")
    )


class CleaningCounts:
    """Rows read, dropped by each rule and written, counted by the job that cleans them.

    Give ``watch`` to ``clean_trips`` and ask for ``counts`` once the rows are written; no
    row is read for it.
    """

    RULES = {"incomplete": ("read", "complete"), "no_zone": ("complete", "located"), "no_id": ("located", "written")}

    def __init__(self) -> None:
        self._points: dict[str, Observation] = {}

    def watch(self, rows: DataFrame, point: str) -> DataFrame:
        self._points[point] = Observation(f"{point}_{uuid.uuid4().hex}")
        return rows.observe(self._points[point], F.count(F.lit(1)).alias("rows"))

    def counts(self) -> dict[str, int]:
        """rows_read, dropped by rule (incomplete, no_zone, no_id), rows_written."""
        rows = {point: seen.get["rows"] for point, seen in self._points.items()}
        dropped = {rule: rows[a] - rows[b] for rule, (a, b) in self.RULES.items()}
        return {"rows_read": rows["read"], **dropped, "rows_written": rows["written"]}
