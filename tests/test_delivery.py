"""Files that arrive in drops, with restarts between, against one load of all."""

import pathlib

import pytest
from pyspark.sql import functions as F

from meterline.plans import delivery, pipeline

from .test_pipeline import corrupt, deliver, land


def layer(spark, raw):
    """Rows by source; months differ in types, so each is read by itself."""
    out = {}
    for folder in pathlib.Path(raw).glob("*/*/source=*"):
        rows = spark.read.parquet(str(folder))
        out[str(folder.relative_to(raw))] = sorted(map(str, rows.select(sorted(rows.columns)).collect()))
    return out


def test_drops_with_restarts_equal_one_load(spark, raw_trips, tmp_path, monkeypatch):
    base, raw, mark, whole = (str(tmp_path / n) for n in ("in", "raw", "mark", "whole"))

    def follow(**how):
        return delivery.follow_delivery(spark, base, raw, mark, **how)

    land(raw_trips("green", {}), base, 2024, "green", 9)
    assert follow() == []
    deliver(raw_trips, base)
    path = land(raw_trips("yellow", {"fare_amount": 3.0}), base, 2024, "yellow", 6)

    # A run stops after it has loaded its first batch and before that is marked as done.
    loaded, load = [], delivery.load_inputs

    def stops(*args, **how):
        out = load(*args, **how)
        loaded.append(args[2])
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(delivery, "load_inputs", stops)
        with pytest.raises(Exception, match="stopped"):
            follow(files_per_batch=2)
    assert loaded
    assert follow(files_per_batch=2) == []
    # A further part of an input that is there makes it anew as a whole.
    raw_trips("yellow", {"fare_amount": 4.0}).coalesce(1).write.mode("append").parquet(path)
    follow()
    pipeline.load_raw(spark, base, whole, [2023, 2024])
    assert layer(spark, raw) == layer(spark, whole)

    calls = []
    monkeypatch.setattr(delivery, "load_inputs", lambda *args, **how: calls.append(args) or [])
    assert follow() == [] and calls == []


def test_folders_as_inputs_and_faulty_files(spark, raw_trips, tmp_path):
    base, raw, mark = (str(tmp_path / n) for n in ("in", "raw", "mark"))
    layout = "{base}/{service}/year={year}/month=*/"
    for month, fare in ((1, 1.0), (2, 2.0)):
        trips = raw_trips("green", {"fare_amount": fare})
        trips.coalesce(1).write.parquet(f"{base}/green/year=2024/month={month}")
    corrupt(f"{base}/green/year=2024/month=2")
    left_out = delivery.follow_delivery(spark, base, raw, mark, services=["green"], layout=layout, skip_failed=True)
    assert [p.rsplit("/", 1)[-1] for p in left_out] == ["month=2"]
    rows = spark.read.parquet(f"{raw}/service=green")
    assert [(r.source, r.fare_amount) for r in rows.select("source", F.col("fare_amount")).collect()] == [("month=1", 1.0)]
    # What failed is tried again by the load that looks at all files.
    assert len(pipeline.load_raw(spark, base, raw, [2024], services=["green"], layout=layout, skip_failed=True)) == 1
