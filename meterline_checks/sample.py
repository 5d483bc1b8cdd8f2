"""Trip and zone tables derived from the order tables of a data folder.

The order data has no nulls and no unknown keys; the rules below bring in nulls,
unmatched keys and codes out of range, so that every operator has rows to reject.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.operators.joins import fits_broadcast, lookup_join
from meterline.schemas import SERVICES
from meterline.session import stored, unsorted_folders


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sample_zones(spark: SparkSession, folder: str) -> DataFrame:
    """One zone per nation: 24 gets a number no trip uses, 3 and 7 have no coordinates."""
    nation = _table(spark, folder, "nation")
    region = _table(spark, folder, "region")
    key = F.col("n_nationkey")
    located = ~key.isin(3, 7)
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.when(key == 24, F.lit(264)).otherwise(key).alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("zone"),
        F.lit("Boro Zone").alias("service_zone"),
        F.when(located, key + F.lit(40.0)).alias("latitude"),
        F.when(located, F.lit(-74.0) - key).alias("longitude"),
    )


def _first_of(at: str, unit: str):
    return F.trunc(F.col(at).cast("date"), unit)


def placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """What a trip takes of its order and that order's customer: one row per order.

    Stored, as the trips of each service are joined with it by themselves.
    """
    orders = _table(spark, folder, "orders").withColumnsRenamed({"o_custkey": "customer"})
    customers = _table(spark, folder, "customer").select(
        F.col("c_custkey").alias("customer"), F.col("c_nationkey").alias("DOLocationID")
    )
    status = F.col("o_orderstatus")
    taken = orders.select(
        F.col("o_orderkey").alias("order"),
        "customer",
        F.when(status == "F", 1).when(status == "O", 2).otherwise(3).alias("vendor"),
        _first_of("o_orderdate", "month").alias("picked_up"),
        F.substring("o_orderpriority", 1, 1).alias("priority"),
    )
    # Orders meet customers first: fewer rows take part than if order lines did.
    return stored(lookup_join(taken, customers, "customer").drop("customer"), "placed")


def sample_trips(spark: SparkSession, folder: str) -> DataFrame:
    """One trip per order line, both services together, with ``service_type``."""
    lines = _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order"),
        F.col("l_suppkey").alias("supplier"),
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        _first_of("l_shipdate", "quarter").alias("dropped_off"),
    )
    suppliers = _table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("supplier"), (F.col("s_nationkey") % 5).alias("PULocationID")
    )
    # Suppliers come first: what their number becomes is smaller to shuffle than it is. All
    # that a trip takes of its order line is as small before the shuffle as afterwards.
    supplied = lookup_join(lines, suppliers, "supplier").drop("supplier")
    placed = placed_orders(spark, folder)
    small = fits_broadcast(placed)
    # Beyond that bound Spark would still go by the size of the files, which are compressed.
    joined = lookup_join(supplied, placed if small else placed.hint("merge"), "order", small=small)
    trips = joined.select(
        F.col("vendor").cast("bigint").alias("VendorID"),
        F.col("picked_up").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("dropped_off").cast("timestamp_ntz").alias("dropoff_datetime"),
        F.when(F.col("l_quantity") != 50, F.col("l_quantity")).alias("passenger_count"),
        (F.col("l_quantity") * 2.5).alias("trip_distance"),
        F.col("l_linenumber").cast("double").alias("RatecodeID"),
        F.when(F.col("l_returnflag") != "R", F.lit("N")).alias("store_and_fwd_flag"),
        "PULocationID",
        "DOLocationID",
        F.col("priority").cast("bigint").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        F.round(F.col("l_tax") * 50, 1).alias("extra"),
        F.lit(0.5).alias("mta_tax"),
        F.round(F.col("l_discount") * 100, 0).alias("tip_amount"),
        F.round(F.col("l_tax") * 10, 1).alias("tolls_amount"),
        F.lit(1.0).alias("improvement_surcharge"),
        F.when(F.col("l_returnflag") == "R", 2.5).otherwise(0.0).alias("congestion_surcharge"),
        F.when(F.col("l_quantity") < 25, 1.75).alias("fee"),
        F.when(F.col("l_returnflag") != "A", F.lit(1)).alias("trip_type"),
        F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(2)).alias("service_type"),
    )
    parts = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount")
    total = F.col(parts[0])
    for name in (*parts[1:], "improvement_surcharge", "congestion_surcharge"):
        total = total + F.col(name)
    return trips.withColumn("total_amount", F.round(total, 2))


# Names the two services give to their columns.
RAW_NAMES = {
    "yellow": {
        "pickup_datetime": "tpep_pickup_datetime",
        "dropoff_datetime": "tpep_dropoff_datetime",
        "fee": "Airport_fee",
    },
    "green": {
        "pickup_datetime": "lpep_pickup_datetime",
        "dropoff_datetime": "lpep_dropoff_datetime",
        "fee": "ehail_fee",
    },
}


RAW_PICKUP = {service: names["pickup_datetime"] for service, names in RAW_NAMES.items()}


def as_raw(trips: DataFrame, service: str) -> DataFrame:
    """The trips of one service as that service would deliver them."""
    own = trips.where(F.col("service_type") == SERVICES[service])
    hidden = ["service_type"] + (["trip_type"] if service == "yellow" else [])
    return own.drop(*hidden).withColumnsRenamed(RAW_NAMES[service])


def land_sample(spark: SparkSession, folder: str, base: str) -> str:
    """Write raw trips and the zone lookup below ``base``; returns the trips' layout.

    The order lines of each service are joined by themselves, so that each line is
    shuffled once and its trip written once. The joined rows are only dealt to folders,
    without a shuffle and a sort by folder.
    """
    trips = sample_trips(spark, folder)
    for service in SERVICES:
        raw = as_raw(trips, service).withColumn("year", F.year(RAW_PICKUP[service]))
        with unsorted_folders(spark):
            raw.write.mode("overwrite").partitionBy("year").parquet(f"{base}/{service}")
    sample_zones(spark, folder).write.mode("overwrite").csv(f"{base}/zones", header=True)
    return "{base}/{service}/year={year}/"
