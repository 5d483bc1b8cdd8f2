"""A fact laid out by time and place lets a report on a week skip most of it."""

import datetime as dt
import pathlib

import pytest
from pyarrow.parquet import ParquetFile
from pyspark.sql import functions as F

from meterline.schemas import STAR, conform
from meterline.sinks import versions

PRODUCTION = "clustered_star"
WEEK = (dt.datetime(2024, 3, 4), dt.datetime(2024, 3, 11))


@pytest.fixture(scope="module")
def stores(spark, tmp_path_factory):
    """A year of trips, a third of them in one zone, stored plain and clustered."""
    folder = str(tmp_path_factory.mktemp("clustered"))
    spark.sql(f"CREATE DATABASE {PRODUCTION} LOCATION '{folder}/p'")
    versions.create_store(spark, PRODUCTION, f"{folder}/s", row_group_bytes=32_768)
    minute = F.pmod(F.xxhash64("id"), F.lit(366 * 24 * 60)).cast("int")
    trips = spark.range(300_000, numPartitions=6).withColumns(
        {
            **{f.name: F.lit(None).cast(f.dataType) for f in STAR["factTrip"].fields},
            "trip_id": F.md5(F.col("id").cast("string")),
            "pickup_datetime": F.timestamp_add("MINUTE", minute, F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")),
            "pickup_location_id": F.when(F.col("id") % 3 == 0, 132).otherwise(F.pmod(F.hash("id"), F.lit(260))),
            "service_type_id": F.lit(1),
            "total_amount": F.col("id") % 100 + F.lit(0.5),
        }
    )
    trips = conform(trips, STAR["factTrip"]).withColumn("batch_year", F.lit(2024))
    out = {}
    for build, clustered in (("plain", False), ("clustered", True)):
        rows = versions.store_rows(trips, PRODUCTION, "factTrip", build, clustered=clustered)
        found = list(pathlib.Path(folder, "s/facttrip", f"build={build}").rglob("*.parquet"))
        out[build] = (rows, found)
    yield out
    for schema in (PRODUCTION, versions.store_schema(PRODUCTION)):
        spark.sql(f"DROP DATABASE {schema} CASCADE")


def row_groups(files):
    """How many row groups there are, and how many can hold a pickup of the week."""
    total = hit = 0
    for file in files:
        meta = ParquetFile(file).metadata
        column = meta.schema.names.index("pickup_datetime")
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(column).statistics
            total += 1
            hit += stats.min < WEEK[1] and stats.max >= WEEK[0]
    return total, hit


def test_a_week_reads_a_tenth_of_the_row_groups(stores):
    total, hit = row_groups(stores["clustered"][1])
    assert total >= 40 and hit <= total / 10
    total, hit = row_groups(stores["plain"][1])
    assert hit == total  # what it was before


def test_the_same_rows_come_back(stores):
    def report(df):
        at = F.col("pickup_datetime")
        week = df.where((at >= F.lit(WEEK[0]).cast("timestamp_ntz")) & (at < F.lit(WEEK[1]).cast("timestamp_ntz")))
        return week.groupBy("pickup_location_id").agg(F.count(F.lit(1)), F.sum("total_amount"), F.min("trip_id"))

    plain, clustered = (sorted(map(tuple, report(df).collect())) for df, _ in stores.values())
    assert plain == clustered and plain
