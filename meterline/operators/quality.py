"""Data checks: expectations on staging and tests on the star schema."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import COORDINATES
from .joins import fits_broadcast


@dataclass(frozen=True)
class NotNull:
    """Every value is there."""

    column: str
    check = "not_null"

    def missed(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class Between:
    """Every value lies in a range, ends included; nulls are not judged, NaN fails."""

    column: str
    min_value: float | None = None
    max_value: float | None = None
    check = "between"

    def missed(self) -> Column:
        value = F.col(self.column)
        low = F.lit(False) if self.min_value is None else value < self.min_value
        high = F.lit(False) if self.max_value is None else value > self.max_value
        return value.isNotNull() & (low | high)


Expectation = NotNull | Between
_KINDS = {kind.check: kind for kind in (NotNull, Between)}

# The suite the staging table is held to.
STAGING_SUITE: tuple[Expectation, ...] = (
    NotNull("vendor_id"),
    NotNull("rate_code_id"),
    NotNull("dropoff_location_id"),
    NotNull("pickup_location_id"),
    NotNull("payment_type_id"),
    NotNull("service_type"),
    *[NotNull(name) for name in COORDINATES],
    Between("trip_distance", 0, 100),
    Between("extra", 0, 3),
)


def suite_to_json(suite: Iterable[Expectation]) -> str:
    """A suite as text that can be kept beside the data."""
    return json.dumps([{"check": e.check, **asdict(e)} for e in suite], indent=2)


# Names of the checks in the stored form of suites that other tools share.
STORED_NAMES = {
    "expect_column_values_to_not_be_null": NotNull,
    "expect_column_values_to_be_between": Between,
}


def suite_to_stored(suite: Iterable[Expectation], name: str) -> str:
    """A named suite in the form with ``expectation_type`` and ``kwargs``; open ends are left out."""
    types = {kind: stored for stored, kind in STORED_NAMES.items()}
    rows = [
        {
            "expectation_type": types[type(e)],
            "kwargs": {k: v for k, v in asdict(e).items() if v is not None},
            "meta": {},
        }
        for e in suite
    ]
    return json.dumps({"expectation_suite_name": name, "expectations": rows, "meta": {}}, indent=2)


def _from_stored(row: Mapping) -> Expectation:
    kind = STORED_NAMES.get(row["expectation_type"])
    known = set(kind.__dataclass_fields__) if kind else set()
    strange = sorted(k for k, v in row["kwargs"].items() if v is not None and k not in known)
    if kind is None or strange:
        # Half a check would pass what the whole one objects to.
        raise ValueError(f"no such check here: {row['expectation_type']} {', '.join(strange)}".strip())
    return kind(**{k: v for k, v in row["kwargs"].items() if k in known})


def suite_from_json(text: str) -> tuple[Expectation, ...]:
    """A suite from either form; a stored check or argument that is unknown is an error."""
    rows = json.loads(text)
    if isinstance(rows, dict):
        return tuple(_from_stored(row) for row in rows["expectations"])
    return tuple(
        _KINDS[row["check"]](**{k: v for k, v in row.items() if k != "check"}) for row in rows
    )


def validate(df: DataFrame, suite: Iterable[Expectation] = STAGING_SUITE) -> DataFrame:
    """One row per expectation: counts, share of unexpected values, success.

    All counts come from one aggregation, so the table is read once and only the
    columns the suite names. The share is taken of all rows for ``not_null`` and of
    the non-null rows for ``between``; without such rows it is null.
    """
    suite = tuple(suite)
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, e in enumerate(suite):
        counts.append(F.count_if(F.col(e.column).isNull()).alias(f"missing_{i}"))
        counts.append(F.count_if(e.missed()).alias(f"unexpected_{i}"))
    reports = [_report(i, e) for i, e in enumerate(suite)]
    return df.agg(*counts).select(F.inline(F.array(*reports)))


def _report(i: int, e: Expectation) -> Column:
    counts = [F.col("rows"), F.col(f"missing_{i}"), F.col(f"unexpected_{i}")]
    return F.struct(*_judged(i, e, *counts))


def _judged(i: int, e: Expectation, rows: Column, missing: Column, unexpected: Column) -> list[Column]:
    judged = rows if isinstance(e, NotNull) else rows - missing
    return [
        F.lit(i + 1).alias("position"),
        F.lit(e.check).alias("check"),
        F.lit(e.column).alias("column"),
        F.lit(getattr(e, "min_value", None)).cast("double").alias("min_value"),
        F.lit(getattr(e, "max_value", None)).cast("double").alias("max_value"),
        rows.alias("element_count"),
        missing.alias("missing_count"),
        unexpected.alias("unexpected_count"),
        F.try_divide(unexpected * F.lit(100.0), judged).alias("unexpected_percent"),
        (unexpected == 0).alias("success"),
    ]


def check_counts(df: DataFrame, suite: Iterable[Expectation], *by: str) -> DataFrame:
    """The counts a suite needs, for each value of ``by`` and expectation: they add up.

    ``combined_report`` of the counts of parts is ``validate`` of all their rows.
    """
    suite = tuple(suite)
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, e in enumerate(suite):
        counts.append(F.count_if(F.col(e.column).isNull()).alias(f"missing_{i}"))
        counts.append(F.count_if(e.missed()).alias(f"unexpected_{i}"))
    each = [
        F.struct(
            F.lit(i + 1).alias("position"),
            F.col("rows").alias("element_count"),
            F.col(f"missing_{i}").alias("missing_count"),
            F.col(f"unexpected_{i}").alias("unexpected_count"),
        )
        for i in range(len(suite))
    ]
    return df.groupBy(*by).agg(*counts).select(*by, F.inline(F.array(*each)))


def combined_report(counts: DataFrame, suite: Iterable[Expectation] = STAGING_SUITE) -> DataFrame:
    """The report of ``validate`` from the ``check_counts`` of all parts; none count as 0."""
    suite = tuple(suite)
    sums = {}
    for i in range(len(suite)):
        mine = F.col("position") == i + 1
        for name in ("element_count", "missing_count", "unexpected_count"):
            sums[f"{name}_{i}"] = F.coalesce(F.sum(F.when(mine, F.col(name))), F.lit(0).cast("long"))
    total = counts.agg(*[value.alias(name) for name, value in sums.items()])
    names = ("element_count", "missing_count", "unexpected_count")
    reports = [F.struct(*_judged(i, e, *[F.col(f"{n}_{i}") for n in names])) for i, e in enumerate(suite)]
    return total.select(F.inline(F.array(*reports)))


def unexpected_rows(df: DataFrame, expectation: Expectation) -> DataFrame:
    """The rows an expectation objects to."""
    return df.where(expectation.missed())


# The column tests of the star schema.
UNIQUE = {
    "dimVendor": "vendor_key",
    "dimRateCode": "rate_code_key",
    "dimPayment": "payment_type_key",
    "dimService": "service_type_id",
    "dimPickupLocation": "pickup_location_id",
    "dimDropoffLocation": "dropoff_location_id",
}
NOT_NULL = {
    "factTrip": (
        "vendor_key",
        "rate_code_key",
        "pickup_location_id",
        "dropoff_location_id",
        "payment_type_key",
        "service_type_id",
        "passenger_count",
        "trip_distance",
        "total_amount",
    ),
    "dimVendor": ("vendor_key", "vendor_name"),
    "dimRateCode": ("rate_code_key", "rate_code_description"),
    "dimPayment": ("payment_type_key", "payment_description"),
    "dimService": ("service_type_id", "service_name"),
    "dimPickupLocation": ("pickup_location_id", "pickup_latitude", "pickup_longitude"),
    "dimDropoffLocation": ("dropoff_location_id", "dropoff_latitude", "dropoff_longitude"),
}
RELATIONSHIPS = {
    "vendor_key": "dimVendor",
    "rate_code_key": "dimRateCode",
    "pickup_location_id": "dimPickupLocation",
    "dropoff_location_id": "dimDropoffLocation",
    "payment_type_key": "dimPayment",
    "service_type_id": "dimService",
}


def failed_not_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows without a value, per column; one aggregation for all columns."""
    columns = list(columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("failures")) for c in columns
    ]
    return counts.select(F.inline(F.array(*pairs)))


def failed_unique(df: DataFrame, column: str) -> DataFrame:
    """Number of values that occur more than once; nulls are left out."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    return repeated.agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(column).alias("column"), "failures"
    )


def failed_relationship(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str | None = None
) -> DataFrame:
    """Number of child rows whose key has no parent; null keys are left out.

    The child is counted per key, so one row per key is shuffled to meet the parent,
    however uneven the keys are. Where Spark finds the parent small enough to broadcast
    it looks the rows up before counting, which then needs no shuffle of them either.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("rows")
    )
    parents = parent.select(F.col(parent_column or column).alias(column))
    orphans = keys.join(parents, column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failures")).select(
        F.lit(column).alias("column"), "failures"
    )


def failed_dependency(df: DataFrame, key: str, *dependents: str) -> DataFrame:
    """Number of keys that come with several values of ``dependents``; null keys are left out.

    Names the smallest such key and how many values it has. Nulls among the dependents are
    a value. Rows are reduced to distinct ones in each task, so a hot key is one row.
    """
    values = df.where(F.col(key).isNotNull()).select(key, *dependents).distinct()
    repeated = values.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return repeated.agg(
        F.count(F.lit(1)).alias("failures"),
        F.min(key).cast("string").alias("sample_key"),
        F.min_by("n", key).alias("sample_values"),
    ).select(F.lit(key).alias("column"), F.lit(", ".join(dependents)).alias("depends"), "*")


def location_tests(staging: DataFrame) -> DataFrame:
    """Whether each location has one place, so that the location dimensions have one row for it.

    Where it has several, the fact repeats its trips.
    """
    checks = [
        failed_dependency(staging, f"{role}_location_id", f"{role}_latitude", f"{role}_longitude")
        for role in ("pickup", "dropoff")
    ]
    return _stack(checks).withColumn("success", F.col("failures") == 0)


def _named(counts: DataFrame, model: str, test: str) -> DataFrame:
    return counts.select(
        F.lit(model).alias("model"),
        "column",
        F.lit(test).alias("test"),
        "failures",
        (F.col("failures") == 0).alias("success"),
    )


def not_null_tests(
    star: Mapping[str, DataFrame], models: Iterable[str] = tuple(NOT_NULL)
) -> DataFrame:
    return _stack(_named(failed_not_null(star[m], NOT_NULL[m]), m, "not_null") for m in models)


def unique_tests(star: Mapping[str, DataFrame]) -> DataFrame:
    return _stack(_named(failed_unique(star[m], c), m, "unique") for m, c in UNIQUE.items())


def relationship_tests(star: Mapping[str, DataFrame]) -> DataFrame:
    fact = star["factTrip"]
    return _stack(
        _named(failed_relationship(fact, c, star[m]), "factTrip", "relationships")
        for c, m in RELATIONSHIPS.items()
    )


def fact_tests(star: Mapping[str, DataFrame]) -> DataFrame:
    """Missing values and orphans of the fact, in one pass over it.

    The distinct keys of small parents (counted first) are broadcast to the fact, and one
    aggregation counts everything. A parent too large for that is tested by itself.
    """
    fact, counts, apart = star["factTrip"], [], []
    for c in NOT_NULL["factTrip"]:
        counts.append((c, "not_null", F.count_if(F.col(c).isNull())))
    looked_up = fact
    for i, (c, m) in enumerate(RELATIONSHIPS.items()):
        if not fits_broadcast(star[m]):
            apart.append(_named(failed_relationship(fact, c, star[m]), "factTrip", "relationships"))
            continue
        known = f"_known{i}"
        keys = star[m].select(c).where(F.col(c).isNotNull()).distinct().withColumn(known, F.lit(True))
        looked_up = looked_up.join(F.broadcast(keys), c, "left")
        orphan = F.col(c).isNotNull() & F.col(known).isNull()
        counts.append((c, "relationships", F.count_if(orphan)))
    totals = looked_up.agg(*[count.alias(f"n{i}") for i, (_, _, count) in enumerate(counts)])
    rows = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("test"), F.col(f"n{i}").alias("failures"))
        for i, (c, t, _) in enumerate(counts)
    ]
    together = totals.select(F.inline(F.array(*rows))).select(
        F.lit("factTrip").alias("model"),
        "column",
        "test",
        "failures",
        (F.col("failures") == 0).alias("success"),
    )
    return _stack([together, *apart])


def _stack(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def star_tests(star: Mapping[str, DataFrame]) -> DataFrame:
    """All 35 column tests: model, column, test, failures, success.

    Sizes of the dimensions are counted while the plan is built; the fact is read once.
    """
    dimensions = [m for m in NOT_NULL if m != "factTrip"]
    return _stack((not_null_tests(star, dimensions), unique_tests(star), fact_tests(star)))
