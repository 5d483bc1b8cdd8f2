"""Staging rows -> six dimensions and the fact table."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from ..functions import (
    payment_description,
    rate_code_description,
    service_name,
    surrogate_key,
    vendor_name,
)
from ..schemas import MEASURES, STAR, TIME_COLUMNS, conform
from .joins import lookup_join

# Vendors and rate codes from these numbers on have no dimension row.
VENDOR_END = 3
RATE_CODE_END = 7

# Natural key of each dimension.
NATURAL_KEYS = {
    "dimVendor": "vendor_id",
    "dimRateCode": "rate_code_id",
    "dimPayment": "payment_type_id",
    "dimService": "service_type_id",
    "dimPickupLocation": "pickup_location_id",
    "dimDropoffLocation": "dropoff_location_id",
}


def _distinct(staging: DataFrame, *names: str) -> DataFrame:
    """Distinct values of ``names`` with a key, over rows that have a vendor.

    Both tests stand before the distinct, where the scan can use them. Each task
    reduces its rows to distinct values before the shuffle, so a hot value is one row.
    """
    known = F.col("vendor_id").isNotNull() & F.col(names[0]).isNotNull()
    return staging.where(known).select(*names).distinct()


def dim_vendor(staging: DataFrame) -> DataFrame:
    vendors = _distinct(staging.where(F.col("vendor_id") < VENDOR_END), "vendor_id")
    return vendors.select(
        surrogate_key(vendors, "vendor_id").alias("vendor_key"),
        F.col("vendor_id").cast("int").alias("vendor_id"),
        vendor_name("vendor_id").alias("vendor_name"),
    )


def dim_rate_code(staging: DataFrame) -> DataFrame:
    # The warehouse rounds when it casts, so 6.7 counts as 7.
    in_range = F.rint("rate_code_id") < RATE_CODE_END
    codes = _distinct(staging.where(in_range), "rate_code_id")
    return codes.select(
        surrogate_key(codes, "rate_code_id").alias("rate_code_key"),
        "rate_code_id",
        rate_code_description("rate_code_id").alias("rate_code_description"),
    )


def dim_payment(staging: DataFrame) -> DataFrame:
    payments = _distinct(staging, "payment_type_id")
    return payments.select(
        surrogate_key(payments, "payment_type_id").alias("payment_type_key"),
        "payment_type_id",
        payment_description("payment_type_id").alias("payment_description"),
    )


def dim_service(staging: DataFrame) -> DataFrame:
    return _distinct(staging, "service_type").select(
        F.col("service_type").alias("service_type_id"),
        service_name("service_type").alias("service_name"),
    )


def dim_pickup_location(staging: DataFrame) -> DataFrame:
    return _distinct(staging, "pickup_location_id", "pickup_latitude", "pickup_longitude")


def dim_dropoff_location(staging: DataFrame) -> DataFrame:
    return _distinct(staging, "dropoff_location_id", "dropoff_latitude", "dropoff_longitude")


DIMENSIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dimVendor": dim_vendor,
    "dimRateCode": dim_rate_code,
    "dimPayment": dim_payment,
    "dimService": dim_service,
    "dimPickupLocation": dim_pickup_location,
    "dimDropoffLocation": dim_dropoff_location,
}


def in_key_order(dim: DataFrame, name: str) -> DataFrame:
    """A dimension for display; a stored table keeps no order, so it is not sorted."""
    return dim.orderBy(NATURAL_KEYS[name])


def fact_trip(staging: DataFrame, dims: Mapping[str, DataFrame], *also: str) -> DataFrame:
    """Staging rows that have a row in each of five dimensions, with their keys.

    ``also`` names further staging columns to keep, such as the year of delivery.

    Only the key columns of a dimension take part. A location that has several
    coordinates repeats its trips, as a plain join does. With small dimensions the
    whole fact is one pass over staging without a shuffle.
    """
    trips = staging
    for name, surrogate in (
        ("dimVendor", "vendor_key"),
        ("dimRateCode", "rate_code_key"),
        ("dimPayment", "payment_type_key"),
        ("dimPickupLocation", None),
        ("dimDropoffLocation", None),
    ):
        natural = NATURAL_KEYS[name]
        keys = [natural, surrogate] if surrogate else [natural]
        trips = lookup_join(trips, dims[name].select(*keys), natural)
    trip_id = surrogate_key(
        trips,
        "vendor_id",
        "rate_code_id",
        "pickup_location_id",
        "dropoff_location_id",
        "payment_type_id",
        "service_type",
        "pickup_datetime",
        "dropoff_datetime",
    )
    keyed = trips.select(
        trip_id.alias("trip_id"),
        "vendor_key",
        "rate_code_key",
        "pickup_location_id",
        "dropoff_location_id",
        "payment_type_key",
        F.col("service_type").alias("service_type_id"),
        *TIME_COLUMNS,
        *MEASURES,
        *also,
    )
    return conform(keyed, StructType([*STAR["factTrip"].fields, *[keyed.schema[c] for c in also]]))


def build_star(
    staging: DataFrame,
    store: Callable[[str, DataFrame], DataFrame],
    *,
    facts: Callable[[Mapping[str, DataFrame]], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All seven tables, dimensions first.

    ``facts`` makes the fact rows from the stored dimensions; without it they are those of
    all of ``staging``.

    ``store`` keeps a finished table and returns it as read back, so the fact joins
    stored dimensions of known size. ``staging`` should be a stored table: each
    dimension then reads only its own one to three columns of it. The dimensions do not
    depend on each other, so their jobs run side by side.
    """
    with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
        dims = pool.map(lambda name: store(name, DIMENSIONS[name](staging)), DIMENSIONS)
        star = dict(zip(DIMENSIONS, dims))
    star["factTrip"] = store("factTrip", facts(star) if facts else fact_trip(staging, star))
    return star


def revenue_by_vendor(star: Mapping[str, DataFrame]) -> DataFrame:
    """Trips and revenue per pickup year and vendor."""
    vendors = star["dimVendor"]
    by_key = (
        star["factTrip"]
        .groupBy(F.year("pickup_datetime").alias("year"), "vendor_key")
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.sum("passenger_count").alias("passengers"),
            F.sum("fare_amount").alias("fares"),
            F.sum("total_amount").alias("revenue"),
        )
    )
    # Joined after the grouping: one row per year and vendor meets the dimension.
    return lookup_join(by_key, vendors, "vendor_key").select(
        "year",
        "vendor_id",
        "vendor_name",
        "trips",
        F.round("passengers", 2).alias("passengers"),
        F.round("fares", 2).alias("fares"),
        F.round("revenue", 2).alias("revenue"),
    )
