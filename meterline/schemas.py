"""Column lists and table schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

_I, _D, _S, _T = IntegerType(), DoubleType(), StringType(), TimestampNTZType()


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Service name -> service code stored in the warehouse.
SERVICES = {"yellow": 1, "green": 2}

# The ten summed measures, in table order.
MEASURES = (
    "passenger_count",
    "trip_distance",
    "extra",
    "mta_tax",
    "fare_amount",
    "tip_amount",
    "tolls_amount",
    "total_amount",
    "improvement_surcharge",
    "congestion_surcharge",
)

# Source id column -> (warehouse name, warehouse type).
ID_COLUMNS = {
    "VendorID": ("vendor_id", _I),
    "RatecodeID": ("rate_code_id", _D),
    "PULocationID": ("pickup_location_id", _I),
    "DOLocationID": ("dropoff_location_id", _I),
    "payment_type": ("payment_type_id", _I),
}

# Group key columns that keep their source name.
TIME_COLUMNS = ("pickup_datetime", "dropoff_datetime")
COORDINATES = ("pickup_latitude", "pickup_longitude", "dropoff_latitude", "dropoff_longitude")
CALENDAR = ("year", "month", "dow")

ZONES = _schema(LocationID=_I, Borough=_S, zone=_S, service_zone=_S, latitude=_D, longitude=_D)

STAGING = StructType(
    [StructField("year", _I), StructField("month", _S), StructField("dow", _S)]
    + [StructField(name, kind) for name, kind in ID_COLUMNS.values()]
    + [StructField(name, _T) for name in TIME_COLUMNS]
    + [StructField(name, _D) for name in COORDINATES + MEASURES]
    + [StructField("service_type", _I)]
)

# The declared warehouse table stores the year as text.
STAGING_AS_DECLARED = StructType(
    [StructField("year", _S) if f.name == "year" else f for f in STAGING.fields]
)

STAR = {
    "dimVendor": _schema(vendor_key=_S, vendor_id=_I, vendor_name=_S),
    "dimRateCode": _schema(rate_code_key=_S, rate_code_id=_D, rate_code_description=_S),
    "dimPayment": _schema(payment_type_key=_S, payment_type_id=_I, payment_description=_S),
    "dimService": _schema(service_type_id=_I, service_name=_S),
    "dimPickupLocation": _schema(
        pickup_location_id=_I, pickup_latitude=_D, pickup_longitude=_D
    ),
    "dimDropoffLocation": _schema(
        dropoff_location_id=_I, dropoff_latitude=_D, dropoff_longitude=_D
    ),
    "factTrip": StructType(
        [
            StructField("trip_id", _S),
            StructField("vendor_key", _S),
            StructField("rate_code_key", _S),
            StructField("pickup_location_id", _I),
            StructField("dropoff_location_id", _I),
            StructField("payment_type_key", _S),
            StructField("service_type_id", _I),
        ]
        + [StructField(name, _T) for name in TIME_COLUMNS]
        + [StructField(name, _D) for name in MEASURES]
    ),
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project ``df`` onto ``schema``: its columns, its order, its types."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
