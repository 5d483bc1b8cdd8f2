"""Bringing staging and star up to date, and switching readers from one star to the next."""

import pathlib
import re

import pytest
from pyspark.sql import functions as F

from meterline.operators.cleaning import clean_trips
from meterline.operators.grouping import staging_input, staging_rows, union_services
from meterline.operators.star import build_star
from meterline.plans import pipeline
from meterline.schemas import SERVICES, STAR
from meterline.session import stored
from meterline.sinks import versions
from meterline.sources.warehouse import read_staging, read_star

from .test_pipeline import corrupt, deliver, land, warehouse  # noqa: F401
from .test_plans import plan

YEARS = [2023, 2024]


def rows(df):
    return sorted(map(str, df.collect()))


def everything(spark, made):
    star = read_star(spark, made.production)
    return {**{n: rows(df) for n, df in star.items()}, "staging": rows(read_staging(spark, made.staging_table))}


def star_of(held):
    return {name: held[name] for name in STAR}


@pytest.fixture()
def lake(spark, raw_trips, tmp_path, zones, warehouse):  # noqa: F811
    """A delivery, its layers and warehouse, and what they must hold."""

    class Lake:
        base = deliver(raw_trips, str(tmp_path / "delivery"))
        made = warehouse

        def update(self, **how):
            how = {"mirror": True, **how}
            return pipeline.run_changed(
                spark, self.base, str(tmp_path / "lake"), zones, warehouse, YEARS, **how
            )

        def expected(self):
            """Staging and star made at once from every delivered file."""
            parts = []
            for file in pathlib.Path(self.base).glob("*/*/*/*.parquet"):
                year, service = file.parts[-4:-2]
                clean = clean_trips(spark.read.parquet(str(file)), zones, service, small=True)
                tagged = clean.withColumns({"service_type": F.lit(SERVICES[service]), "batch_year": F.lit(year)})
                parts.append(staging_input(tagged, "service_type", "batch_year"))
            staging = stored(staging_rows(union_services(*parts), "batch_year").drop("batch_year"), "expected")
            star = build_star(staging, lambda name, df: df)
            return {**{name: rows(df) for name, df in star.items()}, "staging": rows(staging)}

        def parts(self):
            return dict(versions.current(spark, warehouse.production).fact)

    return Lake()


def test_changes_add_up_to_a_full_run(spark, lake, raw_trips):
    lake.update()
    assert everything(spark, lake.made) == lake.expected()
    first = lake.parts()
    assert set(first) == {"2023/1", "2024/1", "2024/2"}

    # One month is replaced, one comes in two parts that differ, one loses all its rows.
    land(raw_trips("yellow", {"fare_amount": 6.5}, {"VendorID": 2}), lake.base, 2024, "yellow", 1)
    path = f"{lake.base}/2024/yellow/yellow_tripdata_2024-05.parquet"
    for extra in (None, 0.75):
        part = raw_trips("yellow", {"fare_amount": 2.0})
        part = part if extra is None else part.withColumn("cbd_fee", F.lit(extra))
        part.coalesce(1).write.mode("append").parquet(path)
    land(raw_trips("green", {"passenger_count": None}), lake.base, 2024, "green", 1)
    lake.update()
    assert everything(spark, lake.made) == lake.expected()
    parts = lake.parts()
    assert set(parts) == {"2023/1", "2024/1"}
    assert parts["2023/1"] == first["2023/1"] and parts["2024/1"] != first["2024/1"]

    # One is added, one withdrawn; then nothing happens.
    land(raw_trips("green", {"fare_amount": 1.0}), lake.base, 2023, "green", 3)
    for file in pathlib.Path(lake.base, "2023/yellow").rglob("*"):
        if file.is_file():
            file.unlink()
    lake.update()
    assert everything(spark, lake.made) == lake.expected()
    assert set(lake.parts()) == {"2023/2", "2024/1"}
    before = lake.parts()
    lake.update()
    assert lake.parts() == before


def test_months_that_fail_keep_what_they_had(spark, lake, raw_trips):
    lake.update()
    before = everything(spark, lake.made)
    corrupt(land(raw_trips("yellow", {"fare_amount": 9.0}), lake.base, 2024, "yellow", 1), keep=40)
    left_out = []
    lake.update(skip_failed=True, left_out=left_out)
    assert len(left_out) == 1 and "2024-01" in left_out[0]
    assert everything(spark, lake.made) == before


def test_a_table_emptied_by_hand_is_staged_again(spark, lake):
    lake.update()
    before = everything(spark, lake.made)
    spark.sql(f"ALTER TABLE {lake.made.staging_table} DROP PARTITION (batch_year=2024, service_type=2)")
    lake.update()
    assert everything(spark, lake.made) == before


def test_a_location_in_two_places_rebuilds_all_parts(spark, lake, raw_trips):
    lake.update()
    first = set(lake.parts().values())
    moved = raw_trips("green", {}).withColumns({"pickup_latitude": F.lit(1.0), "pickup_longitude": F.lit(2.0)})
    land(moved, lake.base, 2024, "green", 7)
    lake.update()
    assert not first & set(lake.parts().values())
    assert everything(spark, lake.made) == lake.expected()


def test_readers_see_one_version(spark, lake, raw_trips, monkeypatch):
    old = lake.update()
    before = everything(spark, lake.made)
    production, seen = lake.made.production, []
    store = pipeline.store_rows

    def between(df, schema, name, build, **how):
        out = store(df, schema, name, build, **how)
        seen.append((name, rows(spark.table(f"{production}.factTrip")), rows(spark.table(f"{production}.dimVendor"))))
        return out

    land(raw_trips("yellow", {"VendorID": 2, "fare_amount": 3.0}), lake.base, 2024, "yellow", 1)
    with monkeypatch.context() as m:
        m.setattr(pipeline, "store_rows", between)
        new = lake.update()
    assert {name for name, *_ in seen} == set(STAR)
    assert all(read == [before["factTrip"], before["dimVendor"]] for _, *read in seen)
    after = everything(spark, lake.made)
    assert after["factTrip"] != before["factTrip"]
    assert star_of(after) == {name: rows(spark.table(f"{production}.{name}")) for name in STAR}
    # A reader that began with the old star ends with it, until old builds are dropped.
    assert {name: rows(df) for name, df in old.items()} == star_of(before)
    valid = versions.current(spark, production)
    assert versions.drop_old_builds(spark, production) > 0
    assert versions.drop_old_builds(spark, production) == 0
    assert versions.current(spark, production) == valid
    assert {name: rows(df) for name, df in new.items()} == star_of(after)


def test_a_build_that_stops_leaves_the_old_star(spark, lake, raw_trips, monkeypatch):
    lake.update()
    before = everything(spark, lake.made)
    land(raw_trips("yellow", {"VendorID": 2, "fare_amount": 3.0}), lake.base, 2024, "yellow", 1)
    store = pipeline.store_rows

    def stops(df, schema, name, build, **how):
        out = store(df, schema, name, build, **how)
        if name == stop_at:
            raise RuntimeError("stopped")
        return out

    def no_switch(*_):
        raise RuntimeError("stopped")

    for stop_at in ("dimVendor", "factTrip", "switch"):
        with monkeypatch.context() as m:
            m.setattr(pipeline, "store_rows", stops)
            if stop_at == "switch":
                m.setattr(pipeline, "switch", no_switch)
            with pytest.raises(RuntimeError):
                lake.update()
        star = read_star(spark, lake.made.production)
        assert {name: rows(df) for name, df in star.items()} == star_of(before)
    lake.update()
    assert everything(spark, lake.made) == lake.expected()


def test_a_dimension_filter_prunes_the_fact(spark, lake, raw_trips):
    lake.update()
    schema = lake.made.production
    land(raw_trips("yellow", {"fare_amount": 3.0}), lake.base, 2024, "yellow", 1)
    lake.update()
    report = spark.sql(
        f"""SELECT service_name, sum(total_amount) FROM {schema}.factTrip f
        JOIN {schema}.dimService s ON f.service_type_id = s.service_type_id
        WHERE s.service_name LIKE 'Green%' GROUP BY service_name"""
    )
    text = plan(report, "formatted")
    fact = next(p for p in text.split("\n\n") if "facttrip" in p.lower() and "PartitionFilters" in p)
    assert "dynamicpruningexpression(service_type_id" in fact
    # The valid builds are picked while planning: folders of older ones are no part of the scan.
    builds = set(lake.parts().values())
    assert set(re.findall(r"build=(\w+)", fact)) <= builds and len(builds) == 2
    assert report.collect()[0][1] > 0
    # Only the folders of one service are read.
    metrics = report._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in metrics
    everything_read = spark.table(f"{schema}.factTrip").select(F.input_file_name().alias("f")).distinct().count()
    one = spark.table(f"{schema}.factTrip").where("service_type_id = 2")
    assert one.select(F.input_file_name().alias("f")).distinct().count() < everything_read


def test_a_plain_star_gives_way_to_views(spark, warehouse):  # noqa: F811
    pipeline.create_warehouse(spark, warehouse)
    spark.range(1).write.saveAsTable(f"{warehouse.production}.dimVendor")
    pipeline.load_star(spark, warehouse)
    assert {t.tableType for t in spark.catalog.listTables(warehouse.production)} == {"VIEW"}
    assert spark.table(f"{warehouse.production}.dimVendor").count() == 0


def test_a_suite_reads_changed_partitions_only(spark, lake, raw_trips, tmp_path, monkeypatch):
    counts, read = str(tmp_path / "counts"), []
    count = pipeline.check_counts

    def counted(df, suite, *by):
        read.append(sorted(set(re.findall(r"batch_year=\d+/service_type=\d", " ".join(r.f for r in df.select(F.input_file_name().alias("f")).distinct().collect())))))
        return count(df, suite, *by)

    monkeypatch.setattr(pipeline, "check_counts", counted)

    def report():
        got = pipeline.validate_changed(spark, lake.made, counts).collect()
        assert got == pipeline.validate_staging(spark, lake.made).collect()

    pipeline.create_warehouse(spark, lake.made)
    report()
    lake.update()
    report()
    report()
    land(raw_trips("yellow", {"fare_amount": 3.0, "extra": 9.0}), lake.base, 2024, "yellow", 1)
    lake.update()
    report()
    every = ["batch_year=2023/service_type=1", "batch_year=2024/service_type=1", "batch_year=2024/service_type=2"]
    assert [r for r in read if r] == [every, ["batch_year=2024/service_type=1"]]
