"""Writes into partition folders neither sort nor shuffle their rows for it."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from meterline.session import OPEN_FILES, unsorted_folders
from meterline.sinks.layers import write_layer
from meterline_checks.queries import drifted_parts
from meterline_checks.sample import land_sample

SETTING = "spark.sql.maxConcurrentOutputFileWriters"
SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def writes(monkeypatch):
    """Of each partitioned write: whether tasks may hold files open, and the plan."""
    seen = []
    columns, parquet, save = DataFrameWriter.partitionBy, DataFrameWriter.parquet, DataFrameWriter.save

    def partition_by(self, *names):
        self.by_folder = True
        return columns(self, *names)

    def noted(write):
        def run(self, path, *args, **kwargs):
            if getattr(self, "by_folder", False):
                plan = self._df._jdf.queryExecution().optimizedPlan().toString()
                seen.append((self._df.sparkSession.conf.get(SETTING, "0"), plan))
            return write(self, path, *args, **kwargs)

        return run

    monkeypatch.setattr(DataFrameWriter, "partitionBy", partition_by)
    monkeypatch.setattr(DataFrameWriter, "parquet", noted(parquet))
    monkeypatch.setattr(DataFrameWriter, "save", noted(save))
    return seen


def _insert_plan(spark) -> str:
    return spark.sql("EXPLAIN INSERT INTO by_folder SELECT id, id % 3 FROM range(9)").first()[0]


def test_rows_are_not_sorted_by_folder(spark):
    spark.sql("DROP TABLE IF EXISTS by_folder")
    spark.sql("CREATE TABLE by_folder (id bigint, p bigint) USING parquet PARTITIONED BY (p)")
    try:
        assert "Sort" in _insert_plan(spark)
        with unsorted_folders(spark):
            with unsorted_folders(spark):
                assert "Sort" not in _insert_plan(spark)
            assert "Sort" not in _insert_plan(spark)
        assert "Sort" in _insert_plan(spark)
    finally:
        spark.sql("DROP TABLE by_folder")


def test_a_setting_of_the_session_is_kept(spark):
    spark.conf.set(SETTING, "5")
    try:
        with unsorted_folders(spark):
            assert spark.conf.get(SETTING) == "5"
        assert spark.conf.get(SETTING) == "5"
    finally:
        spark.conf.unset(SETTING)


def test_more_folders_than_open_files(spark, tmp_path, writes):
    n = 3 * OPEN_FILES
    rows = spark.range(20 * n, numPartitions=2).withColumn("p", F.col("id") % n)
    write_layer(rows, str(tmp_path / "layer"), partition_by=("p",))
    assert [setting for setting, _ in writes] == [str(OPEN_FILES)]
    back = spark.read.parquet(str(tmp_path / "layer"))
    assert sorted(map(tuple, back.select("id", "p").collect())) == [(i, i % n) for i in range(20 * n)]
    assert spark.conf.get(SETTING, "0") == "0"


def test_raw_trips_are_dealt_to_folders_as_they_come(spark, tmp_path, writes):
    land_sample(spark, SMALL, str(tmp_path / "landing"))
    assert len(writes) == 2
    assert all(s == str(OPEN_FILES) and "RebalancePartitions" not in plan for s, plan in writes)

def test_drifted_parts_are_dealt_to_folders_as_they_come(spark, writes):
    assert drifted_parts(spark, SMALL).count() > 0
    assert all(s == str(OPEN_FILES) and "RebalancePartitions" not in plan for s, plan in writes)
