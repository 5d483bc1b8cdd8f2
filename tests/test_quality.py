import math

import pytest
from pyspark.sql import functions as F

from meterline.operators import quality
from meterline.operators.profile import null_profile, preview
from meterline.operators.quality import Between, NotNull


@pytest.fixture()
def distances(spark):
    return spark.createDataFrame([(0.0,), (100.0,), (100.01,), (None,)], "d double")


def test_range_ends_are_inside(distances):
    row = quality.validate(distances, [Between("d", 0, 100)]).first()
    assert (row.element_count, row.missing_count, row.unexpected_count) == (4, 1, 1)
    assert row.unexpected_percent == pytest.approx(100 / 3)
    assert not row.success
    bad = quality.unexpected_rows(distances, Between("d", 0, 100)).collect()
    assert [r.d for r in bad] == [100.01]


def test_one_sided_ranges_and_nan(spark):
    df = spark.createDataFrame([(-1.0,), (math.nan,), (5.0,)], "d double")
    report = quality.validate(df, [Between("d", 0), Between("d", max_value=9), NotNull("d")])
    assert [(r.unexpected_count, r.min_value, r.max_value) for r in report.collect()] == [
        (1, 0.0, None),
        (1, None, 9.0),
        (0, None, None),
    ]


def test_empty_table_passes(distances):
    report = quality.validate(distances.where("d > 1000"), [NotNull("d"), Between("d", 0, 1)])
    assert [(r.element_count, r.unexpected_percent, r.success) for r in report.collect()] == [
        (0, None, True),
        (0, None, True),
    ]


def test_suite_order_and_size():
    suite = quality.STAGING_SUITE
    assert len(suite) == 12
    assert quality.suite_from_json(quality.suite_to_json(suite)) == suite


def test_suites_in_the_stored_form():
    text = """{"data_asset_type": null, "expectation_suite_name": "trips", "expectations": [
        {"expectation_type": "expect_column_values_to_not_be_null", "kwargs": {"column": "vendor_id"}, "meta": {}},
        {"expectation_type": "expect_column_values_to_be_between",
         "kwargs": {"column": "extra", "max_value": 3, "min_value": 0}, "meta": {}}], "meta": {}}"""
    assert quality.suite_from_json(text) == (NotNull("vendor_id"), Between("extra", 0, 3))
    suite = (*quality.STAGING_SUITE, Between("fare_amount", max_value=9.5))
    assert quality.suite_from_json(quality.suite_to_stored(suite, "all")) == suite
    assert '"min_value"' not in quality.suite_to_stored(suite[-1:], "one")
    for old, new in (("to_not_be_null", "to_be_unique"), ('"column": "extra"', '"column": "extra", "mostly": 0.9')):
        with pytest.raises(ValueError, match="no such check here"):
            quality.suite_from_json(text.replace(old, new))


def test_null_profile_of_empty_input_is_zero(spark):
    df = spark.createDataFrame([(1, None), (None, "x")], "`a.b` int, c string")
    assert tuple(null_profile(df).first()) == (1, 1)
    assert tuple(null_profile(df.limit(0)).first()) == (0, 0)
    assert preview(df, 1).count() == 1


def test_unique_ignores_nulls(spark):
    df = spark.createDataFrame([(5, 1.0), (5, 2.0), (None, 1.0), (None, 1.0)], "k int, v double")
    assert quality.failed_unique(df, "k").first().failures == 1
    assert quality.failed_unique(df.where("v > 1"), "k").first().failures == 0


def test_relationship_counts_child_rows(spark):
    child = spark.createDataFrame([(1,), (9,), (9,), (None,)], "k int")
    parent = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    assert quality.failed_relationship(child, "k", parent, "id").first().failures == 2
    assert quality.failed_relationship(child.where("k = 1"), "k", parent, "id").first().failures == 0


def test_star_has_35_tests(spark):
    star = {
        model: spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        for model, columns in quality.NOT_NULL.items()
    }
    report = quality.star_tests(star).collect()
    assert len(report) == 35
    assert all(r.success and r.failures == 0 for r in report)
    kinds = {k: sum(r.test == k for r in report) for k in ("not_null", "unique", "relationships")}
    assert kinds == {"not_null": 23, "unique": 6, "relationships": 6}


def test_large_parents_are_tested_alike(spark, monkeypatch):
    star = {
        model: spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        for model, columns in quality.NOT_NULL.items()
    }
    fact = quality.NOT_NULL["factTrip"]
    schema = ", ".join(f"{c} string" for c in fact)
    star["factTrip"] = spark.createDataFrame([("a",) * len(fact), (None,) * len(fact)], schema)
    star["dimVendor"] = spark.createDataFrame(
        [("a", "x"), ("a", "y"), (None, "z")], "vendor_key string, vendor_name string"
    )
    small = sorted(quality.fact_tests(star).collect())
    monkeypatch.setattr("meterline.operators.quality.fits_broadcast", lambda df: False)
    assert sorted(quality.fact_tests(star).collect()) == small
    found = {(r.column, r.test): r.failures for r in small}
    assert found["vendor_key", "relationships"] == 0
    assert found["rate_code_key", "relationships"] == 1
    assert found["vendor_key", "not_null"] == 1


def test_star_tests_report_failures(spark):
    star = {
        model: spark.createDataFrame([], ", ".join(f"{c} string" for c in columns))
        for model, columns in quality.NOT_NULL.items()
    }
    star["dimPayment"] = spark.createDataFrame(
        [("k", None), ("k", "Cash")], "payment_type_key string, payment_description string"
    )
    fact = quality.NOT_NULL["factTrip"]
    star["factTrip"] = spark.createDataFrame(
        [tuple("k" if c == "payment_type_key" else "?" for c in fact)],
        ", ".join(f"{c} string" for c in fact),
    )
    failed = {
        (r.model, r.column, r.test): r.failures
        for r in quality.star_tests(star).collect()
        if not r.success
    }
    assert failed == {
        ("dimPayment", "payment_description", "not_null"): 1,
        ("dimPayment", "payment_type_key", "unique"): 1,
        ("factTrip", "vendor_key", "relationships"): 1,
        ("factTrip", "rate_code_key", "relationships"): 1,
        ("factTrip", "pickup_location_id", "relationships"): 1,
        ("factTrip", "dropoff_location_id", "relationships"): 1,
        ("factTrip", "service_type_id", "relationships"): 1,
    }


def test_counts_of_parts_add_up_to_the_report(spark):
    df = spark.createDataFrame(
        [(1, 0.5, "a"), (1, None, None), (2, 7.0, "a"), (2, math.nan, None), (3, 2.0, "b")],
        "part int, d double, s string",
    )
    suite = [Between("d", 0, 3), NotNull("s"), Between("part", min_value=2)]
    parts = [quality.check_counts(df.where(F.col("part") == p), suite, "part") for p in (1, 2, 3)]
    together = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert quality.combined_report(together, suite).collect() == quality.validate(df, suite).collect()
    assert quality.check_counts(df, suite, "part").count() == 9
    none = quality.check_counts(df.limit(0), suite, "part")
    assert quality.combined_report(none, suite).collect() == quality.validate(df.limit(0), suite).collect()


def test_dependencies_name_a_key(spark):
    rows = [(5, 1.0, "x"), (5, 1.0, "x"), (7, 1.0, None), (7, 1.0, "y"), (6, 2.0, "x"), (6, 3.0, "x")]
    df = spark.createDataFrame([*rows, (None, 1.0, "x"), (None, 2.0, "x")], "k int, v double, w string")
    found = quality.failed_dependency(df, "k", "v", "w").first()
    assert tuple(found) == ("k", "v, w", 2, "6", 2)
    assert tuple(quality.failed_dependency(df, "k", "v").first()) == ("k", "v", 1, "6", 2)
    held = quality.failed_dependency(df.where("k = 5"), "k", "v", "w").first()
    assert tuple(held) == ("k", "v, w", 0, None, None)
    assert quality.failed_dependency(df.limit(0), "k", "v").first().failures == 0


def test_locations_in_two_places(spark):
    columns = [f"{r}_{c}" for r in ("pickup", "dropoff") for c in ("location_id", "latitude", "longitude")]
    df = spark.createDataFrame([(1, 0.0, 0.0, 2, 0.0, 0.0), (1, 0.0, 0.0, 2, 0.0, 9.0)], columns)
    got = {r.column: (r.failures, r.sample_key, r.success) for r in quality.location_tests(df).collect()}
    assert got == {"pickup_location_id": (0, None, True), "dropoff_location_id": (1, "2", False)}
