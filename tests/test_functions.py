import hashlib
import math

import pytest
from pyspark.sql import functions as F

from meterline import functions as fn


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_null_part_counts_as_empty_text(spark):
    df = spark.createDataFrame([("1", None)], "a string, b string")
    key = df.select(fn.surrogate_key(df, "a", "b").alias("k")).first().k
    assert key == md5("1-")


@pytest.mark.parametrize(
    ("value", "text"),
    [
        (1.0, "1"),
        (0.0, "0"),
        (-3.0, "-3"),
        (6.7, "6.7"),
        (99.0, "99"),
        (1e14, "100000000000000"),
        (None, ""),
        (math.nan, "NaN"),
        (math.inf, "Infinity"),
    ],
)
def test_numbers_in_keys(spark, value, text):
    df = spark.createDataFrame([(value,)], "x double")
    assert df.select(fn.surrogate_key(df, "x").alias("k")).first().k == md5(text)


def test_times_in_keys_do_not_depend_on_the_zone(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 00:57:55' AS t")
    key = df.select(fn.surrogate_key(df, "t").alias("k"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert key.first().k == md5("2024-01-01 00:57:55")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_unknown_codes_have_no_description(spark):
    df = spark.createDataFrame([(6, 99.0, 0, 3), (1, 5.0, 6, 2)], "v int, r double, p int, s int")
    rows = df.select(
        fn.vendor_name("v"),
        fn.rate_code_description("r"),
        fn.payment_description("p"),
        fn.service_name("s"),
    ).collect()
    assert tuple(rows[0]) == (None, None, None, None)
    assert tuple(rows[1]) == (
        "Creative Mobile Technologies, LLC",
        "Negoriated fare",
        "Voided trip",
        "Green",
    )


def test_texts_are_a_parameter(spark):
    df = spark.createDataFrame([(5,)], "r int")
    row = df.select(fn.rate_code_description("r", {5: "Negotiated fare"}).alias("t")).first()
    assert row.t == "Negotiated fare"
    assert df.select(fn.describe("r", {}).alias("t")).first().t is None


def test_calendar_names(spark):
    row = spark.sql("SELECT TIMESTAMP_NTZ'2024-02-29 23:59:59' AS t").select(
        fn.month_name("t").alias("m"), fn.weekday_name("t").alias("d")
    ).first()
    assert tuple(row) == ("February", "Thursday")


def test_parts_of_a_path(spark):
    df = spark.createDataFrame(
        [("2024/green/green_tripdata_2024-01.parquet",), ("/green/lake/2024/yellow/a.parquet",)],
        "p string",
    )
    rows = df.select(
        fn.file_name("p").alias("f"),
        fn.path_segment("p", 2).alias("s"),
        fn.path_segment("p", 9).alias("none"),
        fn.service_code_of_path("p").alias("anywhere"),
        fn.service_code_of_path(F.col("p"), "/green/lake/").alias("below"),
    ).collect()
    assert (rows[0].f, rows[0].s, rows[0].none) == (
        "green_tripdata_2024-01.parquet",
        "green",
        None,
    )
    assert [r.anywhere for r in rows] == [2, 2]
    assert [r.below for r in rows] == [2, 1]
