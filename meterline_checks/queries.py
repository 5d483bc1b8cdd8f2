"""One query per operator, each over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.functions import (
    path_segment,
    payment_description,
    rate_code_description,
    service_code_of_path,
    service_name,
    surrogate_key,
    vendor_name,
)
from meterline.operators import quality, star
from meterline.operators.cleaning import (
    ROLES,
    add_zone,
    canonical_columns,
    cast_ids,
    clean_trips,
    complete_rows,
    drop_if_present,
    drop_service_columns,
    rename_service_columns,
    zone_role,
)
from meterline.operators.grouping import (
    add_calendar,
    build_staging,
    grouped_sums,
    staging_input,
    tag_service,
    union_services,
)
from meterline.operators.joins import fits_broadcast, lookup_join
from meterline.operators.profile import null_profile, preview
from meterline.plans import pipeline
from meterline.schemas import MEASURES, SERVICES, STAGING_AS_DECLARED, conform
from meterline.session import new_folder, stored, unsorted_folders
from meterline.sinks.tables import reset_schema, save_table
from meterline.sources.layers import read_tree
from meterline.sources.warehouse import read_staging, read_star
from meterline.sources.zones import read_zones
from meterline_checks.sample import land_sample

Query = Callable[[SparkSession, str], DataFrame]

_landed: dict[tuple[str, str], tuple[str, str]] = {}


def landing(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Raw Parquet trips and zone CSV derived from all of ``sf_dir``: folder and layout.

    Written once per session; every query scans these files.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        base = new_folder(spark, "landing")
        _landed[key] = (base, land_sample(spark, sf_dir, base))
    return _landed[key]


def raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    base, _ = landing(spark, sf_dir)
    return read_tree(spark, f"{base}/{service}")


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup, read from the CSV that landed beside the trips."""
    base, _ = landing(spark, sf_dir)
    return read_zones(spark, f"{base}/zones")


def _per_service(spark: SparkSession, sf_dir: str, step) -> DataFrame:
    """Both services after ``step(raw, service)``, tagged with their service code."""
    return union_services(
        *[step(raw(spark, sf_dir, s), s).transform(tag_service, s) for s in SERVICES]
    )


def aligned(df: DataFrame, service: str) -> DataFrame:
    return (
        drop_if_present(df)
        .transform(rename_service_columns, service)
        .transform(drop_service_columns, service)
        .transform(cast_ids)
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _per_service(spark, sf_dir, aligned)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    lookup = zones(spark, sf_dir)
    small = fits_broadcast(lookup)
    return _per_service(
        spark, sf_dir, lambda df, service: clean_trips(df, lookup, service, small=small)
    )


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_staging(cleaned(spark, sf_dir))


def stored_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    rows = stored(staging(spark, sf_dir), "staging")
    return star.build_star(rows, lambda name, df: stored(df, name))


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Sums of doubles depend on the order of adding in their last digits."""
    return df.withColumns({n: F.round(n, 2) for n in (names or MEASURES)})


# --- sources, projections, filters -------------------------------------------------


def scan_raw_trips(spark, sf_dir):
    shared = [
        "VendorID",
        "RatecodeID",
        "store_and_fwd_flag",
        "PULocationID",
        "DOLocationID",
        "payment_type",
        *MEASURES,
    ]
    return _per_service(spark, sf_dir, lambda df, _: df.select(*shared))


def zone_lookup(spark, sf_dir):
    return zones(spark, sf_dir)


def drop_rename_cast(spark, sf_dir):
    return trips(spark, sf_dir)


def canonical_order(spark, sf_dir):
    return canonical_columns(trips(spark, sf_dir))


def pickup_zone_join(spark, sf_dir):
    return trips(spark, sf_dir).transform(add_zone, zones(spark, sf_dir), "pickup")


def both_zone_join(spark, sf_dir):
    lookup = zones(spark, sf_dir)
    small = fits_broadcast(lookup)
    located = trips(spark, sf_dir)
    # The third call finds the pickup coordinates there and changes nothing.
    for role in ("pickup", "dropoff", "pickup"):
        located = add_zone(located, lookup, role, small=small)
    return located


def both_zone_join_shuffled(spark, sf_dir):
    """The way a lookup too large to broadcast is joined, with every zone a hot key.

    The hot keys are as few as the zone numbers that trips use.
    """
    located = trips(spark, sf_dir)
    lookup = zones(spark, sf_dir)
    for role, location in ROLES.items():
        keyed = located.withColumn("zone", F.col(location))
        part = zone_role(lookup, role).withColumnRenamed("__zone", "zone")
        located = lookup_join(keyed, part, "zone", small=False).drop("zone")
    return located


def complete_trips(spark, sf_dir):
    return complete_rows(both_zone_join(spark, sf_dir))


def clean_trips_query(spark, sf_dir):
    return cleaned(spark, sf_dir)


def calendar_columns(spark, sf_dir):
    return add_calendar(trips(spark, sf_dir)).select(
        "pickup_datetime", "fare_amount", "year", "month", "dow"
    )


def route_by_path(spark, sf_dir):
    base, _ = landing(spark, sf_dir)
    path = F.col("_metadata.file_path")
    below = F.substring_index(path, f"{base}/", -1)
    routed = read_tree(spark, base, "VendorID bigint, fare_amount double").select(
        path_segment(below, 1).alias("service"),
        path_segment(below, 2).alias("folder"),
        service_code_of_path(path, base).alias("service_type"),
        path_segment(below, -1).endswith(".parquet").alias("is_parquet"),
        "fare_amount",
    )
    return (
        routed.groupBy("service", "folder", "service_type", "is_parquet")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("fare_amount").alias("fare_amount"))
        .transform(rounded, "fare_amount")
    )


# --- staging -----------------------------------------------------------------------


def grouped_sums_query(spark, sf_dir):
    rows = staging_input(cleaned(spark, sf_dir), "service_type")
    return rounded(grouped_sums(rows, "service_type"))


def staging_trips(spark, sf_dir):
    return rounded(staging(spark, sf_dir))


def staging_declared(spark, sf_dir):
    return conform(rounded(staging(spark, sf_dir)), STAGING_AS_DECLARED)


def union_services_query(spark, sf_dir):
    """Each service grouped on its own, then all rows of both."""
    lookup = zones(spark, sf_dir)
    small = fits_broadcast(lookup)
    parts = []
    for s in SERVICES:
        clean = clean_trips(raw(spark, sf_dir, s), lookup, s, small=small)
        parts.append(build_staging(clean.transform(tag_service, s)))
    return rounded(union_services(*parts))


# --- star --------------------------------------------------------------------------


def _dimension(name: str) -> Query:
    def query(spark, sf_dir):
        return star.in_key_order(star.DIMENSIONS[name](staging(spark, sf_dir)), name)

    return query


def fact_trip(spark, sf_dir):
    return rounded(stored_star(spark, sf_dir)["factTrip"])


def fact_revenue_by_vendor(spark, sf_dir):
    return star.revenue_by_vendor(stored_star(spark, sf_dir))


def code_descriptions(spark, sf_dir):
    ids = ("VendorID", "RatecodeID", "payment_type", "service_type")
    counted = trips(spark, sf_dir).groupBy(*ids).agg(F.count(F.lit(1)).alias("trips"))
    return counted.select(
        *ids,
        vendor_name("VendorID").alias("vendor_name"),
        rate_code_description("RatecodeID").alias("rate_code_description"),
        payment_description("payment_type").alias("payment_description"),
        service_name("service_type").alias("service_name"),
        "trips",
    )


def surrogate_keys(spark, sf_dir):
    rows = trips(spark, sf_dir)
    parts = ("VendorID", "RatecodeID", "passenger_count", "trip_distance", "pickup_datetime")
    return rows.select(surrogate_key(rows, *parts).alias("trip_key"), *parts)


# --- checks ------------------------------------------------------------------------


def null_profile_query(spark, sf_dir):
    def shared(df, service):
        return df.transform(rename_service_columns, service).transform(
            drop_service_columns, service
        )

    return null_profile(_per_service(spark, sf_dir, shared))


def expect_not_null(spark, sf_dir):
    columns = ("VendorID", "passenger_count", "trip_distance", "payment_type")
    return quality.validate(trips(spark, sf_dir), [quality.NotNull(c) for c in columns])


def expect_between(spark, sf_dir):
    suite = [
        quality.Between("trip_distance", 0, 100),
        quality.Between("extra", 0, 3),
        quality.Between("passenger_count", min_value=10),
        quality.Between("fare_amount", max_value=50_000),
    ]
    return quality.validate(trips(spark, sf_dir), suite)


def expectation_suite(spark, sf_dir):
    suite = quality.suite_from_json(quality.suite_to_json(quality.STAGING_SUITE))
    return quality.validate(staging(spark, sf_dir), suite)


def stored_suite(spark, sf_dir):
    """The staging suite as another tool would store it, with a range open at one end more."""
    suite = (*quality.STAGING_SUITE, quality.Between("fare_amount", max_value=50_000))
    suite = quality.suite_from_json(quality.suite_to_stored(suite, "staging"))
    return quality.validate(staging(spark, sf_dir), suite)


def unexpected_rows(spark, sf_dir):
    too_far = quality.unexpected_rows(
        staging(spark, sf_dir), quality.Between("trip_distance", 0, 100)
    )
    return rounded(too_far).select(
        "vendor_id", "rate_code_id", "pickup_location_id", "dropoff_location_id", "trip_distance"
    )


def test_not_null(spark, sf_dir):
    rows = trips(spark, sf_dir)
    return quality.failed_not_null(rows, rows.columns)


def test_unique(spark, sf_dir):
    rows = trips(spark, sf_dir)
    checks = [quality.failed_unique(zones(spark, sf_dir), "LocationID")]
    for column in ("payment_type", "passenger_count", "pickup_datetime", "fare_amount"):
        checks.append(quality.failed_unique(rows, column))
    return union_services(*checks)


def test_relationships(spark, sf_dir):
    rows = trips(spark, sf_dir)
    lookup = complete_rows(zones(spark, sf_dir))
    return union_services(
        quality.failed_relationship(rows, "PULocationID", lookup, "LocationID"),
        quality.failed_relationship(rows, "DOLocationID", lookup, "LocationID"),
    )


def star_tests(spark, sf_dir):
    return quality.star_tests(stored_star(spark, sf_dir))


def preview_rows(spark, sf_dir):
    dim = star.dim_dropoff_location(staging(spark, sf_dir))
    return preview(star.in_key_order(dim, "dimDropoffLocation"))


# --- stored layers and tables ------------------------------------------------------


def delivered_years(spark, sf_dir) -> list[int]:
    """Years of the delivery; only its folder names are needed."""
    base, _ = landing(spark, sf_dir)
    years = union_services(
        *[spark.read.parquet(f"{base}/{s}").select("year").distinct() for s in SERVICES]
    )
    return sorted({row.year for row in years.collect()})


def _raw_layer(spark, sf_dir) -> str:
    base, layout = landing(spark, sf_dir)
    lake = new_folder(spark, "raw")
    pipeline.load_raw(spark, base, lake, delivered_years(spark, sf_dir), layout=layout)
    return lake


def parquet_roundtrip(spark, sf_dir):
    lake = _raw_layer(spark, sf_dir)
    columns = ("VendorID", "fare_amount", "trip_distance", "service", "batch_year")
    return union_services(
        *[
            spark.read.option("basePath", lake).parquet(f"{lake}/service={s}").select(*columns)
            for s in SERVICES
        ]
    )


def convert_layer(spark, sf_dir):
    """The conversion step; ORC stands in where no Delta jar is installed."""
    lake = _raw_layer(spark, sf_dir)
    clean, target = new_folder(spark, "clean"), new_folder(spark, "converted")
    pipeline.clean_layer(spark, lake, clean, zones(spark, sf_dir))
    pipeline.convert_layer(spark, clean, target, fmt="orc")
    return spark.read.orc(target).drop("source")


def drifted_parts(spark, sf_dir):
    """Inputs whose part files differ: those of vendor 1 have a column more."""
    base, layout = landing(spark, sf_dir)
    delivery, lake, clean = (new_folder(spark, name) for name in ("drifted", "raw", "clean"))
    more = F.col("VendorID") == 1
    for service in SERVICES:
        trips_ = spark.read.parquet(f"{base}/{service}")
        for part in (trips_.where(more).withColumn("cbd_fee", F.lit(0.75)), trips_.where(~more)):
            with unsorted_folders(spark):
                part.write.mode("append").partitionBy("year").parquet(f"{delivery}/{service}")
    years = delivered_years(spark, sf_dir)
    pipeline.load_raw(spark, delivery, lake, years, layout=layout)
    pipeline.clean_layer(spark, lake, clean, zones(spark, sf_dir))
    return spark.read.option("mergeSchema", True).parquet(clean).drop("source")


def convert_drifted(spark, sf_dir):
    """Months that differ in types become one table: whole numbers meet floating ones.

    Passengers are long and tips decimal in the years that 3 does not divide.
    """
    base, layout = landing(spark, sf_dir)
    delivery, lake, clean, target = (
        new_folder(spark, name) for name in ("drifted", "raw", "clean", "converted")
    )
    for service in SERVICES:
        for year in delivered_years(spark, sf_dir):
            trips_ = spark.read.parquet(f"{base}/{service}/year={year}")
            if year % 3:
                kinds = {"passenger_count": "bigint", "tip_amount": "decimal(18,2)"}
                trips_ = trips_.withColumns({c: F.col(c).cast(k) for c, k in kinds.items()})
            trips_.write.parquet(f"{delivery}/{service}/year={year}")
    years = delivered_years(spark, sf_dir)
    pipeline.load_raw(spark, delivery, lake, years, layout=layout)
    pipeline.clean_layer(spark, lake, clean, zones(spark, sf_dir))
    pipeline.convert_layer(spark, clean, target, fmt="orc")
    return spark.read.orc(target).drop("source")


def convert_sources(spark, sf_dir):
    """Every source as a table under its own schema: passengers are long or double as delivered."""
    base, layout = landing(spark, sf_dir)
    delivery, lake, target = (new_folder(spark, name) for name in ("typed", "raw", "converted"))
    years = delivered_years(spark, sf_dir)
    for service in SERVICES:
        for year in years:
            trips_ = spark.read.parquet(f"{base}/{service}/year={year}")
            kind = "bigint" if year % 2 else "double"
            typed = trips_.withColumn("passenger_count", F.col("passenger_count").cast(kind))
            typed.write.parquet(f"{delivery}/{service}/year={year}")
    pipeline.load_raw(spark, delivery, lake, years, layout=layout)
    pipeline.convert_sources(spark, lake, target, fmt="orc")
    tables = []
    for service in SERVICES:
        for year in years:
            try:
                table = spark.read.orc(f"{target}/service={service}/batch_year={year}/source=year%3D{year}")
            except AnalysisException as error:
                if error.getCondition() != "PATH_NOT_FOUND":
                    raise
                continue
            tables.append(
                table.agg(
                    F.count(F.lit(1)).alias("trips"),
                    F.sum(F.col("passenger_count").cast("double")).alias("passengers"),
                ).select(
                    F.lit(service).alias("service"),
                    F.lit(year).alias("batch_year"),
                    F.lit(dict(table.dtypes)["passenger_count"]).alias("passenger_type"),
                    "trips",
                    "passengers",
                )
            )
    return union_services(*tables)


def catalog_tables(spark, sf_dir):
    tag = uuid.uuid4().hex[:12]
    folder = new_folder(spark, "catalog")
    schemas = {name: f"{name}_{tag}" for name in ("staging", "production")}
    for name, schema in schemas.items():
        reset_schema(spark, schema, location=f"{folder}/{name}")
    rows = save_table(staging(spark, sf_dir), f"{schemas['staging']}.trips")
    star.build_star(rows, lambda name, df: save_table(df, f"{schemas['production']}.{name}"))
    tables = read_star(spark, schemas["production"])
    by_service = (
        tables["factTrip"]
        .groupBy("service_type_id")
        .agg(F.count(F.lit(1)).alias("trips"), F.sum("total_amount").alias("revenue"))
    )
    return (
        tables["dimService"]
        .join(by_service, "service_type_id")
        .select("service_type_id", "service_name", "trips", F.round("revenue", 2).alias("revenue"))
    )


def _run(spark, sf_dir) -> dict[str, DataFrame]:
    base, layout = landing(spark, sf_dir)
    tag = uuid.uuid4().hex[:12]
    folder = new_folder(spark, "run")
    warehouse = pipeline.Warehouse(f"staging_{tag}", f"production_{tag}", f"{folder}/warehouse")
    return pipeline.run_all(
        spark,
        base,
        f"{folder}/lake",
        zones(spark, sf_dir),
        warehouse,
        delivered_years(spark, sf_dir),
        layout=layout,
    )


def _deliver_and_correct(spark, sf_dir, bring_up_to_date) -> None:
    """Two deliveries, each followed by a run of ``bring_up_to_date(base, layout, years)``.

    The first has a year of yellow trips of which most are missing and a year of green ones
    too many; the second delivers the one as a whole and withdraws the other. What
    results must be that of the right delivery.
    """
    years = delivered_years(spark, sf_dir)
    landed, _ = landing(spark, sf_dir)
    schema, folder = f"delivery_{uuid.uuid4().hex[:12]}", new_folder(spark, "delivery")
    reset_schema(spark, schema, location=folder)
    year, extra = F.col("year"), years[-1] + 1
    for service in SERVICES:
        trips_ = spark.read.parquet(f"{landed}/{service}")
        first = trips_
        if service == "yellow":
            first = trips_.where((year != years[0]) | (F.col("VendorID") == 2))
        else:
            more = trips_.where(year == years[0]).withColumn("year", F.lit(extra))
            first = trips_.unionByName(more)
        by_year = first.write.partitionBy("year").option("partitionOverwriteMode", "dynamic")
        with unsorted_folders(spark):
            by_year.saveAsTable(f"{schema}.{service}")
    layout = "{base}/{service}/year={year}/"
    bring_up_to_date(folder, layout, [*years, extra])
    whole = spark.read.parquet(f"{landed}/yellow").where(year == years[0])
    with unsorted_folders(spark):
        whole.write.insertInto(f"{schema}.yellow", overwrite=True)
    spark.sql(f"ALTER TABLE {schema}.green DROP PARTITION (year={extra})")
    bring_up_to_date(folder, layout, [*years, extra])


def _new_warehouse(folder: str) -> pipeline.Warehouse:
    tag = uuid.uuid4().hex[:12]
    return pipeline.Warehouse(f"staging_{tag}", f"production_{tag}", f"{folder}/warehouse")


def merged_staging(spark, sf_dir):
    """Staging from sums stored by source, after a replaced and a withdrawn source."""
    folder, lookup = new_folder(spark, "merged"), zones(spark, sf_dir)
    warehouse = _new_warehouse(folder)
    pipeline.create_warehouse(spark, warehouse)

    def run(base, layout, years):
        raw, clean, sums = (f"{folder}/{layer}" for layer in ("raw", "clean", "sums"))
        pipeline.load_raw(spark, base, raw, years, layout=layout, mirror=True)
        pipeline.clean_layer(spark, raw, clean, lookup)
        pipeline.partial_layer(spark, clean, sums)
        pipeline.merge_staging(spark, sums, warehouse)

    _deliver_and_correct(spark, sf_dir, run)
    return rounded(read_staging(spark, warehouse.staging_table))


def incremental_run(spark, sf_dir):
    """Every layer, staging and star brought up to date, after a replaced and a withdrawn source."""
    folder, lookup = new_folder(spark, "incremental"), zones(spark, sf_dir)
    warehouse = _new_warehouse(folder)

    def run(base, layout, years):
        pipeline.run_changed(
            spark, base, f"{folder}/lake", lookup, warehouse, years, layout=layout, mirror=True
        )

    _deliver_and_correct(spark, sf_dir, run)
    return star.revenue_by_vendor(read_star(spark, warehouse.production))


def merged_expectations(spark, sf_dir):
    """The staging suite from counts kept by partition, after a replaced and a withdrawn source."""
    folder, lookup = new_folder(spark, "expectations"), zones(spark, sf_dir)
    warehouse = _new_warehouse(folder)
    pipeline.create_warehouse(spark, warehouse)

    def run(base, layout, years):
        raw, clean, sums = (f"{folder}/{layer}" for layer in ("raw", "clean", "sums"))
        pipeline.load_raw(spark, base, raw, years, layout=layout, mirror=True)
        pipeline.clean_layer(spark, raw, clean, lookup)
        pipeline.partial_layer(spark, clean, sums)
        pipeline.merge_staging(spark, sums, warehouse)
        pipeline.validate_changed(spark, warehouse, f"{folder}/counts")

    _deliver_and_correct(spark, sf_dir, run)
    return pipeline.validate_changed(spark, warehouse, f"{folder}/counts")


def location_dependency(spark, sf_dir):
    """Places depend on location ids; vendors do not depend on how a trip is paid."""
    rows = staging(spark, sf_dir)
    checks = [
        quality.location_tests(rows).drop("success"),
        quality.failed_dependency(rows, "payment_type_id", "vendor_id"),
        quality.failed_dependency(rows, "pickup_location_id", "vendor_id", "service_type"),
    ]
    return union_services(*checks)


def run_metrics(spark, sf_dir):
    """What cleaning read, dropped by rule and wrote, as its own jobs counted it."""
    lake, clean, kept = _raw_layer(spark, sf_dir), new_folder(spark, "clean"), new_folder(spark, "metrics")
    pipeline.clean_layer(spark, lake, clean, zones(spark, sf_dir), metrics=kept)
    rows = spark.read.schema(pipeline.CLEANING_METRICS).parquet(kept)
    numbers = ("rows_read", "incomplete", "no_zone", "no_id", "rows_written")
    return rows.groupBy("service").agg(*[F.sum(n).alias(n) for n in numbers])


def fact_by_service(spark, sf_dir):
    """A report on one service: the dimension's filter picks the folders of the fact."""
    base, layout = landing(spark, sf_dir)
    folder = new_folder(spark, "by_service")
    warehouse = _new_warehouse(folder)
    years = delivered_years(spark, sf_dir)
    pipeline.run_all(
        spark, base, f"{folder}/lake", zones(spark, sf_dir), warehouse, years, layout=layout
    )
    schema = warehouse.production
    return spark.sql(
        f"""SELECT s.service_name, v.vendor_name, count(*) AS trips, round(sum(f.total_amount), 2) AS revenue
        FROM {schema}.factTrip f
        JOIN {schema}.dimService s ON f.service_type_id = s.service_type_id
        JOIN {schema}.dimVendor v ON f.vendor_key = v.vendor_key
        WHERE s.service_name LIKE 'Green%' GROUP BY s.service_name, v.vendor_name"""
    )


def full_run(spark, sf_dir):
    """Every stage over stored layers and tables, then the revenue report."""
    return star.revenue_by_vendor(_run(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "scan_raw_trips": scan_raw_trips,
    "zone_lookup": zone_lookup,
    "drop_rename_cast": drop_rename_cast,
    "canonical_columns": canonical_order,
    "pickup_zone_join": pickup_zone_join,
    "both_zone_join": both_zone_join,
    "both_zone_join_shuffled": both_zone_join_shuffled,
    "complete_rows": complete_trips,
    "clean_trips": clean_trips_query,
    "calendar_columns": calendar_columns,
    "route_by_path": route_by_path,
    "grouped_sums": grouped_sums_query,
    "staging_trips": staging_trips,
    "staging_declared": staging_declared,
    "union_services": union_services_query,
    "dim_vendor": _dimension("dimVendor"),
    "dim_rate_code": _dimension("dimRateCode"),
    "dim_payment": _dimension("dimPayment"),
    "dim_service": _dimension("dimService"),
    "dim_pickup_location": _dimension("dimPickupLocation"),
    "dim_dropoff_location": _dimension("dimDropoffLocation"),
    "fact_trip": fact_trip,
    "fact_revenue_by_vendor": fact_revenue_by_vendor,
    "code_descriptions": code_descriptions,
    "surrogate_keys": surrogate_keys,
    "null_profile": null_profile_query,
    "expect_not_null": expect_not_null,
    "expect_between": expect_between,
    "expectation_suite": expectation_suite,
    "stored_suite": stored_suite,
    "unexpected_rows": unexpected_rows,
    "test_not_null": test_not_null,
    "test_unique": test_unique,
    "test_relationships": test_relationships,
    "star_tests": star_tests,
    "preview_rows": preview_rows,
    "parquet_roundtrip": parquet_roundtrip,
    "convert_layer": convert_layer,
    "drifted_parts": drifted_parts,
    "convert_drifted": convert_drifted,
    "convert_sources": convert_sources,
    "catalog_tables": catalog_tables,
    "full_run": full_run,
    "merged_staging": merged_staging,
    "incremental_run": incremental_run,
    "merged_expectations": merged_expectations,
    "location_dependency": location_dependency,
    "run_metrics": run_metrics,
    "fact_by_service": fact_by_service,
}
