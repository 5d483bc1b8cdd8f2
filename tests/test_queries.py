"""Every query beside its SQL, and the counts known for the sample at sf0.01."""

import pytest

import __spark_entry__ as entry_module
from meterline_checks.compare import connect, differences
from meterline_checks.queries import QUERIES, cleaned, staging, trips, zones
from meterline.operators import quality, star
from meterline.operators.cleaning import add_zone
from meterline.session import stored

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(spark, duck, name, SMALL) == []


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_module.queries())
    assert set(QUERIES) <= set(entry_module.oracle_sql())


def test_entry(spark):
    rows = entry_module.entry(spark).collect()
    assert len(rows) == 14
    assert {r.vendor_id for r in rows} == {1, 2}


def test_known_counts(spark):
    """Values found once by two engines; see FIXTURES.md."""
    all_trips = trips(spark, MEDIUM)
    lookup = zones(spark, MEDIUM)
    located = add_zone(add_zone(all_trips, lookup, "pickup"), lookup, "dropoff")
    rows = stored(staging(spark, MEDIUM), "known")
    tables = star.build_star(rows, lambda name, df: stored(df, name))
    counts = {
        "zones": lookup.count(),
        "trips": all_trips.count(),
        "located": located.count(),
        "clean": cleaned(spark, MEDIUM).count(),
        "staging": rows.count(),
        **{name: df.count() for name, df in tables.items()},
    }
    assert counts == {
        "zones": 25,
        "trips": 60_000,
        "located": 57_532,
        "clean": 43_108,
        "staging": 43_032,
        "dimVendor": 2,
        "dimRateCode": 6,
        "dimPayment": 5,
        "dimService": 2,
        "dimPickupLocation": 4,
        "dimDropoffLocation": 22,
        "factTrip": 24_386,
    }
    fact = tables["factTrip"]
    row = fact.selectExpr(
        "count(DISTINCT trip_id) AS ids",
        "round(sum(fare_amount), 2) AS fares",
        "sum(passenger_count) AS passengers",
        "round(sum(extra), 1) AS extras",
        "min(trip_id) AS first",
    ).first()
    assert tuple(row) == (
        24_386,
        1298870774.34,
        609683.0,
        48906.0,
        "00036519c5e72acad25c77737347ad36",
    )
    report = {(r.check, r.column): r.unexpected_count for r in quality.validate(rows).collect()}
    assert report["between", "trip_distance"] == 7931
    assert report["between", "extra"] == 8098
    revenue = star.revenue_by_vendor(tables).where("year = 1995 AND vendor_id = 1").first()
    assert (revenue.trips, revenue.fares) == (1777, 93516377.75)
