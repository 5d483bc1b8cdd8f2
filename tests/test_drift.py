"""Part files that differ, inputs that fail, and deliveries that come again."""

import pathlib

import pytest
from pyspark.sql import functions as F

from meterline.plans import pipeline
from meterline.sources.layers import list_inputs, scan_by_schema
from meterline.sources.warehouse import read_staging

from .test_pipeline import corrupt, land, warehouse  # noqa: F401

MONTH = "yellow_tripdata_2024-01"


def part(df, path):
    df.coalesce(1).write.mode("append").parquet(path)


def sums(spark, warehouse):  # noqa: F811
    rows = read_staging(spark, warehouse.staging_table).collect()
    return sorted((r.service_type, r.fare_amount) for r in rows)


@pytest.mark.parametrize("more_first", [True, False])
def test_parts_keep_their_own_columns(spark, raw_trips, tmp_path, zones, more_first):
    base, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    path = f"{base}/2024/yellow/{MONTH}.parquet"
    plain = raw_trips("yellow", {"fare_amount": 1.0})
    more = raw_trips("yellow", {"fare_amount": 2.0}).withColumn("cbd_fee", F.lit(0.75))
    parts = [more, plain] if more_first else [plain, more]
    for df in parts:
        part(df, path)
    # Names decide which part is listed first.
    for n, file in enumerate(sorted(pathlib.Path(path).glob("part-*"), key=lambda f: f.stat().st_mtime_ns)):
        pathlib.Path(path, f".{file.name}.crc").unlink()
        file.rename(pathlib.Path(path, f"{n}.parquet"))
    for _ in range(2):
        pipeline.load_raw(spark, base, f"{lake}/raw", [2024])
        pipeline.clean_layer(spark, f"{lake}/raw", f"{lake}/clean", zones)
        for layer in ("raw", "clean"):
            folder = f"{lake}/{layer}/service=yellow/batch_year=2024/source={MONTH}"
            rows = spark.read.option("mergeSchema", True).parquet(folder)
            got = sorted((r.fare_amount, r.cbd_fee) for r in rows.collect())
            assert got == [(1.0, None), (2.0, 0.75)]
    # Only the part that comes again is left; the first schema's earlier rows go as well.
    land(more.where("fare_amount > 5"), base, 2024, "yellow", 1)
    part(plain, path)
    pipeline.load_raw(spark, base, f"{lake}/raw", [2024])
    folder = f"{lake}/raw/service=yellow/batch_year=2024/source={MONTH}"
    assert [r.fare_amount for r in spark.read.parquet(folder).collect()] == [1.0]


def test_a_part_that_fails_leaves_its_input_as_it_was(spark, raw_trips, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    plain = raw_trips("yellow", {"fare_amount": 1.0})
    path = land(plain, base, 2024, "yellow", 1)
    assert pipeline.load_raw(spark, base, raw, [2024]) == []
    land(raw_trips("yellow", {"fare_amount": 8.0}).withColumn("x", F.lit(1)), base, 2024, "yellow", 1)
    corrupt(path, keep=40)
    part(plain.withColumn("fare_amount", F.lit(9.0)), path)
    left_out = pipeline.load_raw(spark, base, raw, [2024], skip_failed=True)
    assert [p.rsplit("/", 1)[-1] for p in left_out] == [f"{MONTH}.parquet"]
    assert [r.fare_amount for r in spark.read.parquet(f"{raw}/service=yellow").collect()] == [1.0]


def test_staged_years_with_a_faulty_source_stay(spark, raw_trips, tmp_path, zones, warehouse):  # noqa: F811
    base, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    for month in (1, 2):
        land(raw_trips("yellow", {"fare_amount": float(month)}), base, 2024, "yellow", month)
    land(raw_trips("green", {"fare_amount": 4.0}), base, 2024, "green", 1)
    pipeline.create_warehouse(spark, warehouse)
    pipeline.load_raw(spark, base, f"{lake}/raw", [2024])
    pipeline.clean_layer(spark, f"{lake}/raw", f"{lake}/clean", zones)
    pipeline.load_staging(spark, f"{lake}/clean", warehouse)
    pipeline.convert_layer(spark, f"{lake}/clean", f"{lake}/orc", fmt="orc")
    before = sums(spark, warehouse)
    assert len(before) == 2

    # A broken page is found by trying the sources, a broken footer beforehand.
    for keep in (40, None):
        folder = f"{lake}/clean/service=yellow/batch_year=2024/source={MONTH}"
        corrupt(folder, keep=keep)
        left_out: list[str] = []
        pipeline.load_staging(
            spark, f"{lake}/clean", warehouse, skip_failed=True, left_out=left_out
        )
        assert [p.rsplit("/", 1)[-1] for p in left_out] == [f"source={MONTH}"]
        assert sums(spark, warehouse) == before
        with pytest.raises(Exception):
            pipeline.load_staging(spark, f"{lake}/clean", warehouse)
        skipped = pipeline.convert_layer(
            spark, f"{lake}/clean", f"{lake}/orc", fmt="orc", skip_unreadable=True
        )
        assert len(skipped) == 1
        assert spark.read.orc(f"{lake}/orc").count() == 3
    # A service of which nothing can be read is not dropped either.
    corrupt(f"{lake}/clean/service=green/batch_year=2024/source=green_tripdata_2024-01")
    left_out = []
    pipeline.load_staging(spark, f"{lake}/clean", warehouse, skip_failed=True, left_out=left_out)
    assert len(left_out) == 2 and sums(spark, warehouse) == before


def test_a_target_that_cannot_be_written_is_an_error(spark, raw_trips, tmp_path):
    base, raw = str(tmp_path / "in"), tmp_path / "raw"
    land(raw_trips("yellow", {}), base, 2024, "yellow", 1)
    raw.write_text("a file, not a folder")
    with pytest.raises(Exception):
        pipeline.load_raw(spark, base, str(raw), [2024], skip_failed=True)


def test_names_with_special_signs_and_new_part_names(spark, tmp_path):
    base, raw = str(tmp_path / "in"), str(tmp_path / "raw")
    names = ["a b", "a%b", "a#b", "a+b", "a[1]", "a=b"]
    for name in names:
        spark.range(2).coalesce(1).write.parquet(f"{base}/2024/green/{name}.parquet")
    for _ in range(2):
        pipeline.load_raw(spark, base, raw, [2024])
        rows = spark.read.parquet(f"{raw}/service=green").groupBy("source").count().collect()
        assert {r.source: r["count"] for r in rows} == dict.fromkeys(names, 2)
    for name in names:
        path = f"{base}/2024/green/{name}.parquet"
        spark.range(0).coalesce(1).write.mode("overwrite").parquet(path)
    pipeline.load_raw(spark, base, raw, [2024])
    assert spark.read.parquet(f"{raw}/service=green").count() == 0

    # Folders as inputs: part files are named anew by each delivery.
    for _ in range(2):
        spark.range(3).write.mode("overwrite").parquet(f"{base}/2023/green/month=1 a")
        pipeline.load_raw(spark, base, raw, [2023], layout="{base}/{year}/{service}/month=*/")
        rows = spark.read.parquet(f"{raw}/service=green").where("batch_year = 2023")
        assert [(r.source, r["count"]) for r in rows.groupBy("source").count().collect()] == [
            ("month=1 a", 3)
        ]


def test_listing_runs_no_job(spark, tmp_path):
    for name in "abc":
        spark.range(1).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        inputs = list_inputs(spark, f"{tmp_path}/*.parquet")
        assert len(inputs) == 3
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("listing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = scan_by_schema(spark, inputs)
    assert len(found.scans) == 1 and found.left_out == ()
