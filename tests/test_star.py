import hashlib

import pytest

from meterline.operators import star
from meterline.schemas import STAGING, STAR


@pytest.fixture()
def staging(spark):
    """Builds staging rows from (vendor, rate, pickup, dropoff, payment, service, lat)."""

    def build(*rows):
        base = spark.createDataFrame(
            rows,
            "vendor_id int, rate_code_id double, pickup_location_id int, "
            "dropoff_location_id int, payment_type_id int, service_type int, "
            "pickup_latitude double",
        )
        rest = {
            f.name: f"CAST({_default(f)} AS {f.dataType.simpleString()})"
            for f in STAGING
            if f.name not in base.columns
        }
        return base.selectExpr("*", *[f"{e} AS {n}" for n, e in rest.items()]).select(
            *STAGING.fieldNames()
        )

    return build


def _default(field):
    kind = field.dataType.simpleString()
    if kind == "timestamp_ntz":
        return "'2024-01-01 00:57:55'"
    return "'January'" if kind == "string" else "1"


def build(rows):
    return star.build_star(rows, lambda name, df: df)


def test_dimension_rows(staging):
    rows = staging(
        (1, 1.0, 1, 1, 1, 1, 1.0),
        (2, 6.0, 1, 1, 0, 2, 1.0),
        (6, 99.0, 2, 1, 2, 2, 1.0),
        (None, 3.0, 4, 1, 3, 2, 1.0),
        (1, None, None, 1, None, 1, 1.0),
    )
    tables = build(rows)
    assert sorted((r.vendor_id, r.vendor_name) for r in tables["dimVendor"].collect()) == [
        (1, "Creative Mobile Technologies, LLC"),
        (2, "VeriFone Inc"),
    ]
    # 3.0 occurs only without a vendor, 99 is out of range.
    assert sorted(r.rate_code_id for r in tables["dimRateCode"].collect()) == [1.0, 6.0]
    payments = {r.payment_type_id: r.payment_description for r in tables["dimPayment"].collect()}
    assert payments == {0: None, 1: "Credit card", 2: "Cash"}
    assert sorted(r.pickup_location_id for r in tables["dimPickupLocation"].collect()) == [1, 2]
    ordered = star.in_key_order(tables["dimService"], "dimService").collect()
    assert [(r.service_type_id, r.service_name) for r in ordered] == [(1, "Yellow"), (2, "Green")]


def test_rate_codes_are_rounded_before_the_bound(staging):
    rows = staging((1, 6.7, 1, 1, 1, 1, 1.0), (1, 6.4, 1, 1, 1, 1, 1.0), (1, 1e12, 1, 1, 1, 1, 1.0))
    assert [r.rate_code_id for r in star.dim_rate_code(rows).collect()] == [6.4]


def test_surrogate_keys_match_between_tables(staging):
    tables = build(staging((1, 1.0, 1, 2, 1, 1, 1.0)))
    fact = tables["factTrip"].first()
    assert fact.vendor_key == hashlib.md5(b"1").hexdigest()
    assert fact.rate_code_key == hashlib.md5(b"1").hexdigest()
    text = "1-1-1-2-1-1-2024-01-01 00:57:55-2024-01-01 00:57:55"
    assert fact.trip_id == hashlib.md5(text.encode()).hexdigest()


def test_fact_keeps_only_rows_with_all_dimensions(staging):
    tables = build(
        staging(
            (1, 1.0, 1, 1, 1, 1, 1.0),
            (3, 1.0, 1, 1, 1, 1, 1.0),
            (1, 7.0, 1, 1, 1, 1, 1.0),
            (1, 1.0, None, 1, 1, 1, 1.0),
            (1, 1.0, 1, 1, None, 1, 1.0),
        )
    )
    assert tables["factTrip"].count() == 1


def test_a_location_with_two_coordinates_repeats_its_trips(staging):
    tables = build(staging((1, 1.0, 5, 1, 1, 1, 1.0), (1, 1.0, 5, 1, 1, 1, 2.0)))
    assert tables["dimPickupLocation"].count() == 2
    assert tables["factTrip"].count() == 4


def test_schemas(staging):
    tables = build(staging((1, 1.0, 1, 1, 1, 1, 1.0)))
    for name, schema in STAR.items():
        assert [(f.name, f.dataType) for f in tables[name].schema] == [
            (f.name, f.dataType) for f in schema
        ], name


def test_empty_staging(staging):
    tables = build(staging((1, 1.0, 1, 1, 1, 1, 1.0)).where("vendor_id > 1"))
    assert all(t.count() == 0 for t in tables.values())
    assert star.revenue_by_vendor(tables).count() == 0


def test_large_dimensions_take_the_shuffle_join(staging, monkeypatch):
    rows = staging(*[(1 + i % 2, 1.0 + i % 6, i % 5, i % 7, 1, 1, 1.0) for i in range(60)])
    wanted = sorted(build(rows)["factTrip"].collect())
    monkeypatch.setattr("meterline.operators.joins.fits_broadcast", lambda df: False)
    assert sorted(build(rows)["factTrip"].collect()) == wanted
