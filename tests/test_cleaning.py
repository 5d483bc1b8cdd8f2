import math
import pathlib

import pytest
from pyspark.sql import functions as F

from meterline.operators.cleaning import (
    CleaningCounts,
    add_zone,
    canonical_columns,
    cast_ids,
    clean_trips,
    complete_rows,
    drop_if_present,
    drop_service_columns,
    rename_service_columns,
)
from meterline.plans import pipeline
from meterline.session import stored

from .test_pipeline import corrupt


def test_complete_rows_drops_null_and_nan(spark):
    df = spark.createDataFrame([(1, math.nan), (2, None), (3, 2.0)], "a int, b double")
    assert [r.a for r in complete_rows(df).collect()] == [3]
    assert complete_rows(df).collect() == df.na.drop().collect()


def test_complete_rows_of_chosen_columns(spark):
    df = spark.createDataFrame([(None, 1), (2, None)], "a int, b int")
    assert [r.a for r in complete_rows(df, ["a"]).collect()] == [2]


def test_complete_rows_reads_odd_names_and_types(spark):
    df = spark.createDataFrame([("x", 1.5), (None, 1.5), ("y", math.nan)], "`a.b` string, c float")
    assert complete_rows(df).count() == 1


def test_drop_if_present(spark):
    df = spark.createDataFrame([(1, "N")], "a int, Store_And_Fwd_Flag string")
    assert drop_if_present(df).columns == ["a"]
    assert drop_if_present(drop_if_present(df)).columns == ["a"]


def test_renames_ignore_case_and_missing_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, airport_fee double")
    assert rename_service_columns(df, "yellow").columns == ["a", "fee"]
    assert drop_service_columns(rename_service_columns(df, "yellow"), "yellow").columns == ["a"]


def test_only_green_loses_the_trip_type(spark):
    df = spark.createDataFrame([(1, 1)], "a int, trip_type int")
    assert drop_service_columns(df, "green").columns == ["a"]
    assert drop_service_columns(df, "yellow").columns == ["a", "trip_type"]


def test_ids_out_of_range_become_null(spark):
    df = spark.createDataFrame(
        [(5_000_000_000, 1.0, "7", 2), (3, 2.0, "x", 2)],
        "payment_type bigint, DOLocationID double, PULocationID string, VendorID int",
    )
    rows = cast_ids(df).collect()
    assert [r.payment_type for r in rows] == [None, 3]
    assert [r.PULocationID for r in rows] == [7, None]
    assert dict(cast_ids(df).dtypes)["DOLocationID"] == "int"


def test_canonical_columns_put_capitals_first(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "b int, VendorID int, a int, DOLocationID int")
    assert canonical_columns(df).columns == ["DOLocationID", "VendorID", "a", "b"]


@pytest.mark.parametrize("small", [True, False])
def test_trips_without_a_known_zone_leave(spark, raw_trips, zones, small):
    df = raw_trips(
        "green", {}, {"PULocationID": 999}, {"PULocationID": None}, {"PULocationID": 21}
    )
    rows = add_zone(df, zones, "pickup", small=small).collect()
    assert sorted(r.PULocationID for r in rows) == [1, 21]
    assert {r.PULocationID: r.pickup_latitude for r in rows} == {1: 40.5, 21: None}
    assert "LocationID" not in rows[0] and "Borough" not in rows[0] and "__zone" not in rows[0]


def test_add_zone_leaves_present_coordinates_alone(raw_trips, zones):
    df = raw_trips("green", {}).withColumn("pickup_latitude", F.lit(9.0))
    assert add_zone(df, zones, "pickup") is df


def test_add_zone_accepts_locations_stored_as_text(raw_trips, zones):
    df = raw_trips("green", {}, {"PULocationID": 2})
    as_text = df.withColumn(
        "PULocationID", F.when(F.col("PULocationID") == 1, "1").otherwise("unknown")
    )
    assert add_zone(as_text, zones, "pickup").count() == 1


def test_clean_trips(raw_trips, zones):
    df = raw_trips(
        "green",
        {},
        {"PULocationID": 21},  # no coordinates
        {"DOLocationID": 999},  # no zone
        {"passenger_count": None},
        {"trip_distance": math.nan},
        {"payment_type": 5_000_000_000},
        extra_columns="ehail_fee double, trip_type int",
        extra_values=(None, None),
    )
    clean = clean_trips(df, zones, "green")
    rows = clean.collect()
    assert len(rows) == 1
    assert clean.columns == sorted(clean.columns)
    assert not {"store_and_fwd_flag", "ehail_fee", "fee", "trip_type"} & set(clean.columns)
    assert (rows[0].pickup_latitude, rows[0].dropoff_longitude) == (40.5, -73.75)
    assert dict(clean.dtypes)["VendorID"] == "int"


def test_clean_trips_equals_filtering_last(raw_trips, zones):
    """The same rows as joining everything first and dropping incomplete rows at the end."""
    trips = [
        {"PULocationID": pu, "DOLocationID": do, "passenger_count": n}
        for pu in (1, 2, 21, 99, None)
        for do in (1, 5, 21, None)
        for n in (1.0, None, math.nan)
    ]
    df = raw_trips("yellow", *trips, extra_columns="Airport_fee double", extra_values=(None,))
    late = (
        drop_if_present(df)
        .transform(add_zone, zones, "pickup")
        .transform(add_zone, zones, "dropoff")
        .transform(rename_service_columns, "yellow")
        .transform(drop_service_columns, "yellow")
        .transform(cast_ids)
        .na.drop()
        .transform(canonical_columns)
    )
    early = clean_trips(df, zones, "yellow")
    assert early.columns == late.columns
    assert sorted(early.collect()) == sorted(late.collect())
    assert early.count() == 4


def test_a_service_only_column_that_stays_takes_part_in_the_filter(raw_trips, zones):
    df = raw_trips("yellow", {}, extra_columns="later_fee double", extra_values=(None,))
    assert clean_trips(df, zones, "yellow").count() == 0


def test_cleaning_counts_what_its_rules_drop(spark, raw_trips, zones):
    trips = raw_trips(
        "yellow",
        {},
        {"passenger_count": None},
        {"fare_amount": math.nan},
        {"PULocationID": 21},
        {"DOLocationID": 999},
        {"VendorID": 5_000_000_000},
    )
    trips = stored(trips, "trips")
    counts = CleaningCounts()
    watched = clean_trips(trips, zones, "yellow", watch=counts.watch)
    plain = clean_trips(trips, zones, "yellow")
    leaves = [p._jdf.queryExecution().optimizedPlan().collectLeaves().size() for p in (watched, plain)]
    assert leaves[0] == leaves[1]  # nothing is read for the counts
    assert sorted(watched.collect()) == sorted(plain.collect())
    assert counts.counts() == {"rows_read": 6, "incomplete": 2, "no_zone": 2, "no_id": 1, "rows_written": 1}


def test_metrics_of_a_layer_are_kept(spark, raw_trips, zones, tmp_path):
    base, raw, clean, kept = (str(tmp_path / n) for n in ("in", "raw", "clean", "metrics"))
    for month in (1, 2, 3):
        rows = [{"fare_amount": float(i)} for i in range(month)] + [{"passenger_count": None}]
        path = f"{base}/2024/yellow/yellow_tripdata_2024-{month:02}.parquet"
        raw_trips("yellow", *rows).coalesce(1).write.parquet(path)
    pipeline.load_raw(spark, base, raw, [2024])
    folder = pathlib.Path(raw, "service=yellow/batch_year=2024/source=yellow_tripdata_2024-02")
    corrupt(folder, keep=40)
    left_out = pipeline.clean_layer(spark, raw, clean, zones, skip_failed=True, metrics=kept)
    assert len(left_out) == 1
    # The job that failed leaves no counts, those of its halves do.
    got = spark.read.parquet(kept).agg(F.sum("rows_read"), F.sum("incomplete"), F.sum("rows_written")).first()
    assert tuple(got) == (6, 2, 4)
    assert spark.read.parquet(clean).count() == 4
    before = spark.read.parquet(kept).count()
    pipeline.clean_layer(spark, raw, clean, zones, skip_failed=True, metrics=kept)
    assert spark.read.parquet(kept).count() == before  # nothing was cleaned
