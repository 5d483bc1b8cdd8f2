"""Runs over deliveries of which nothing, one month or the lookup changed."""

import pathlib

import pytest
from pyspark.sql import functions as F

from meterline.plans import pipeline
from meterline.sources import layers
from meterline.sources.manifest import (
    LEFT_OUT,
    Entry,
    File,
    log_of,
    read_manifest,
    write_manifest,
)

from .test_pipeline import corrupt, deliver, land

YEARS = [2023, 2024]


@pytest.fixture()
def base(raw_trips, tmp_path):
    return deliver(raw_trips, str(tmp_path / "delivery"))


@pytest.fixture()
def opened(monkeypatch):
    """The files whose footers are read, and the scans that are written."""
    seen = {"footers": [], "written": []}

    def footers(spark, files, ask=layers._schemas_of_files):
        seen["footers"] += files
        return ask(spark, files)

    def write(df, path, write=pipeline.write_layer, **how):
        seen["written"] += [f.rsplit("/", 2)[-2] for f in df.inputFiles()]
        return write(df, path, **how)

    monkeypatch.setattr(layers, "_schemas_of_files", footers)
    monkeypatch.setattr(pipeline, "write_layer", write)
    return seen


def files(layer):
    return {str(p.relative_to(layer)) for p in pathlib.Path(layer).glob("*/*/source=*/*.parquet")}


def last_job(spark):
    spark.range(1).collect()
    return max(spark.sparkContext.statusTracker().getJobIdsForGroup(None))


def test_a_second_load_opens_no_file_and_moves_no_row(spark, base, tmp_path, zones, opened):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")

    def run():
        pipeline.load_raw(spark, base, raw, YEARS)
        pipeline.clean_layer(spark, raw, clean, zones)

    run()
    assert len(opened["footers"]) == 4 and len(opened["written"]) == 8
    # The footers of the raw layer are known from its manifest.
    assert not any(f"{tmp_path}/raw" in f for f in opened["footers"])
    before = files(raw) | files(clean)
    opened["footers"].clear(), opened["written"].clear()
    at = last_job(spark)
    run()
    jobs = last_job(spark) - at - 1
    assert opened == {"footers": [], "written": []}
    assert files(raw) | files(clean) == before
    # Two listings, the lookup's mark (two jobs) and six manifests; none for each file.
    assert jobs <= 2 + 2 + 6
    run_full = pipeline.load_raw(spark, base, raw, YEARS, full=True)
    assert run_full == [] and len(opened["written"]) == 4 and opened["footers"] == []


def test_only_the_month_that_changed_is_worked_on(spark, base, tmp_path, zones, opened, raw_trips):
    raw, clean = str(tmp_path / "raw"), str(tmp_path / "clean")
    pipeline.load_raw(spark, base, raw, YEARS)
    pipeline.clean_layer(spark, raw, clean, zones)
    before = files(clean)
    land(raw_trips("yellow", {"fare_amount": 77.0}), base, 2024, "yellow", 2)
    opened["footers"].clear(), opened["written"].clear()
    pipeline.load_raw(spark, base, raw, YEARS)
    pipeline.clean_layer(spark, raw, clean, zones)
    assert len(opened["footers"]) == 1 and "2024-02" in opened["footers"][0]
    assert len(opened["written"]) == 2 and all("2024-02" in f for f in opened["written"])
    assert {f for f in files(clean) - before} and all("2024-02" in f for f in files(clean) - before)
    # A lookup that changed is a reason to clean all of them again.
    pipeline.clean_layer(spark, raw, clean, zones.withColumn("latitude", F.col("latitude") + 1))
    assert not files(clean) & before


def test_folders_changed_by_hand_are_made_anew(spark, base, tmp_path):
    raw = str(tmp_path / "raw")
    pipeline.load_raw(spark, base, raw, YEARS)
    rows = spark.read.parquet(f"{raw}/service=yellow").count()
    january = f"{raw}/service=yellow/batch_year=2024/source=yellow_tripdata_2024-01"
    spark.range(9).write.mode("overwrite").parquet(january)
    for file in pathlib.Path(january.replace("2024-01", "2024-02")).glob("*"):
        file.unlink()
    pipeline.load_raw(spark, base, raw, YEARS)
    assert spark.read.parquet(f"{raw}/service=yellow").count() == rows


def test_what_was_left_out_is_tried_again(spark, base, tmp_path, raw_trips):
    raw = str(tmp_path / "raw")
    pipeline.load_raw(spark, base, raw, YEARS)
    corrupt(land(raw_trips("yellow", {}), base, 2024, "yellow", 1))
    for _ in range(2):
        assert len(pipeline.load_raw(spark, base, raw, YEARS, skip_failed=True)) == 1
        assert spark.read.parquet(f"{raw}/service=yellow").where("fare_amount = 5").count() == 1
    states = log_of(spark, raw, "yellow").where("state is not null").groupBy("state").agg(F.countDistinct("run")).collect()
    assert dict(map(tuple, states))[LEFT_OUT] == 2
    land(raw_trips("yellow", {"fare_amount": 5.5}), base, 2024, "yellow", 1)
    assert pipeline.load_raw(spark, base, raw, YEARS, skip_failed=True) == []
    assert spark.read.parquet(f"{raw}/service=yellow").where("fare_amount = 5.5").count() == 1


def test_withdrawn_months_leave_if_asked(spark, base, tmp_path, opened):
    raw = str(tmp_path / "raw")
    pipeline.load_raw(spark, base, raw, YEARS)
    for path in pathlib.Path(base, "2024").glob("green/*"):
        for file in path.iterdir():
            file.unlink()
        path.rmdir()
    pipeline.load_raw(spark, base, raw, YEARS)
    green = f"{raw}/service=green"
    assert spark.read.parquet(green).count() == 2
    pipeline.load_raw(spark, base, raw, YEARS, mirror=True)
    assert spark.read.parquet(green).count() == 0
    held = files(raw)
    pipeline.load_raw(spark, base, raw, YEARS, mirror=True)
    assert files(raw) == held
    # A delivery of which nothing is found is no reason to empty anything.
    pipeline.load_raw(spark, f"{base}/nowhere", raw, YEARS, mirror=True)
    assert spark.read.parquet(f"{raw}/service=yellow").count() > 0


def test_manifests_keep_the_last_entry(spark, tmp_path):
    layer = str(tmp_path)
    assert read_manifest(spark, layer, "yellow").entries == {}
    key, other = ("2024", "a b%"), ("2023", "c")
    old = Entry(key, "v1", (File("in/1", 5, 7, "{s}"),), (File("out/1", schema="{t}"),))
    write_manifest(spark, layer, "yellow", [old, Entry(other, "w")])
    write_manifest(spark, layer, "yellow", [])
    found = read_manifest(spark, layer, "yellow")
    assert found.entries == {key: old, other: Entry(other, "w")}
    assert found.holds(key, "v1", ["out/1"]) and found.holds(other, "w", [])
    assert not found.holds(key, "v2", ["out/1"]) and not found.holds(key, "v1", [])
    assert found.stored_schemas() == {"out/1": "{t}"}
    assert found.input_schemas({"in/1": (5, 7)}) == {"in/1": "{s}"}
    assert found.input_schemas({"in/1": (6, 7)}) == found.input_schemas({}) == {}
    write_manifest(spark, layer, "yellow", [Entry(key, "v2", state=LEFT_OUT)])
    assert read_manifest(spark, layer, "yellow").entries[key] == old
    new = Entry(key, "v3", (File("in/2", 1, 1),), (File("out/2"), File("out/3")))
    write_manifest(spark, layer, "yellow", [new])
    assert read_manifest(spark, layer, "yellow").entries == {key: new, other: Entry(other, "w")}
    assert read_manifest(spark, layer, "green").entries == {}


def test_sources_converted_by_themselves(spark, base, tmp_path, zones, raw_trips, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "orc")
    path = f"{base}/2024/yellow/yellow_tripdata_2024-07.parquet"
    for extra in (None, 0.75):
        part = raw_trips("yellow", {"fare_amount": 2.0})
        part = part if extra is None else part.withColumn("cbd_fee", F.lit(extra))
        part.coalesce(1).write.mode("append").parquet(path)
    pipeline.load_raw(spark, base, raw, YEARS)
    corrupt(f"{raw}/service=green/batch_year=2024/source=green_tripdata_2024-01", keep=40)
    left_out = pipeline.convert_sources(spark, raw, out, fmt="orc", skip_failed=True)
    assert [p.rsplit("=", 1)[-1] for p in left_out] == ["green_tripdata_2024-01"]
    yellow = f"{out}/service=yellow/batch_year=2024/source=yellow_tripdata_2024"
    kinds = [dict(spark.read.orc(f"{yellow}-0{m}").dtypes)["passenger_count"] for m in (1, 2)]
    assert kinds == ["double", "bigint"]
    both = spark.read.orc(f"{yellow}-07").select("fare_amount", "cbd_fee").collect()
    assert sorted(map(str, both)) == ["Row(fare_amount=2.0, cbd_fee=0.75)", "Row(fare_amount=2.0, cbd_fee=None)"]
    before = {str(p) for p in pathlib.Path(out).glob("*/*/*/*.orc")}
    land(raw_trips("yellow", {"fare_amount": 8.0}), base, 2024, "yellow", 2)
    pipeline.load_raw(spark, base, raw, YEARS)
    pipeline.convert_sources(spark, raw, out, fmt="orc", skip_failed=True)
    now = {str(p) for p in pathlib.Path(out).glob("*/*/*/*.orc")}
    assert {"2024-02" in p for p in now ^ before} == {True}
    assert [r.fare_amount for r in spark.read.orc(f"{yellow}-02").collect()] == [8.0]
