"""What the physical plans must look like to hold at a large scale."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from meterline.operators import quality, star
from meterline.operators.cleaning import clean_trips
from meterline.operators.grouping import build_staging, tag_service, union_services
from meterline.session import stored


def plan(df, mode="simple"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


def shuffles(text):
    return len(re.findall(r"\bExchange\b", text.replace("BroadcastExchange", "")))


@pytest.fixture(scope="module")
def clean(spark, raw_trips, zones):
    lookup = stored(zones, "zones")
    return {
        s: clean_trips(stored(raw_trips(s, {}, {}), s), lookup, s) for s in ("yellow", "green")
    }


@pytest.fixture(scope="module")
def staging(clean):
    both = union_services(*[df.transform(tag_service, s) for s, df in clean.items()])
    return build_staging(both)


def test_cleaning_is_one_pass_with_pushed_filters(clean):
    text = plan(clean["green"])
    assert shuffles(text) == 0
    assert text.count("BroadcastHashJoin") == 2
    assert "PythonUDF" not in text and "CartesianProduct" not in text
    details = plan(clean["green"], "formatted")
    for column in ("VendorID", "lpep_pickup_datetime", "congestion_surcharge"):
        assert re.search(rf"PushedFilters: .*IsNotNull\({column}\)", details)
    schemas = re.findall(r"ReadSchema: struct<(.*)>", details)
    assert any("lpep_pickup_datetime" in s for s in schemas)
    assert all("store_and_fwd_flag" not in s and "Borough" not in s for s in schemas)


def test_staging_shuffles_once_after_partial_sums(staging):
    text = plan(staging)
    assert shuffles(text) == 1
    assert "partial_sum" in text
    # The calendar columns are derived above the shuffle.
    exchange = next(line for line in text.splitlines() if " Exchange " in line or "- Exchange" in line)
    assert "month" not in exchange and "dow" not in exchange


def test_dimensions_read_only_their_columns(staging):
    rows = stored(staging, "staging")
    text = plan(star.dim_vendor(rows))
    assert re.search(r"ReadSchema: struct<vendor_id:int>", text)
    assert "LessThan(vendor_id,3)" in text
    text = plan(star.dim_payment(rows))
    assert re.search(r"ReadSchema: struct<vendor_id:int,payment_type_id:int>", text)


def test_fact_is_one_pass_without_a_shuffle(staging):
    rows = stored(staging, "staging")
    dims = {n: stored(make(rows), n) for n, make in star.DIMENSIONS.items()}
    text = plan(star.fact_trip(rows, dims))
    assert shuffles(text) == 0
    assert text.count("BroadcastHashJoin") == 5


def test_fact_without_small_dimensions_has_no_broadcast_of_them(staging, monkeypatch):
    monkeypatch.setattr("meterline.operators.joins.fits_broadcast", lambda df: False)
    rows = stored(staging, "staging")
    dims = {n: stored(make(rows), n) for n, make in star.DIMENSIONS.items()}
    text = plan(star.fact_trip(rows, dims))
    # Staging and five dimensions, each read once.
    assert text.count("FileScan parquet") == 6


def test_star_tests_read_the_fact_once(staging):
    rows = stored(staging, "staging")
    tables = star.build_star(rows, lambda name, df: stored(df, name))
    details = plan(quality.star_tests(tables), "formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*)>", details)
    assert sum("total_amount" in s for s in schemas) == 1
    assert sum("rate_code_key" in s and "payment_type_key" in s for s in schemas) == 1


def test_a_suite_is_one_pass(staging):
    rows = stored(staging, "staging")
    details = plan(quality.validate(rows), "formatted")
    schemas = re.findall(r"ReadSchema: struct<(.*)>", details)
    assert len(schemas) == 1
    assert "month" not in schemas[0] and "fare_amount" not in schemas[0]


def test_relationships_count_per_key_before_a_shuffled_join(spark):
    child = spark.range(1000).select((F.col("id") % 3).alias("k"))
    parent = spark.range(2).toDF("k")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(quality.failed_relationship(child, "k", parent))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "partial_count" in text[text.index("LeftAnti") :]


def test_a_compacted_layer_is_rebalanced(spark):
    df = spark.range(10).withColumn("p", F.lit(1)).hint("rebalance", F.col("p"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan(df)
