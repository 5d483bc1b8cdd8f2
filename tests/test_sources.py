import logging
import math

import pandas as pd
import pytest
from pyarrow.fs import LocalFileSystem, SubTreeFileSystem
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from meterline.schemas import ZONES
from meterline.session import new_folder, shared_folder, stored
from meterline.sources import layers
from meterline.sources.layers import (
    PARENT_FOLDER,
    DriftError,
    find_service_inputs,
    input_name,
    input_year,
    list_inputs,
    read_parquet,
    read_tree,
    scan_by_schema,
    source_of_path,
    union_drifted,
    year_of_path,
)
from meterline.sources.warehouse import read_jdbc
from meterline.sources.zones import read_zones


def one_file(df, path):
    """Parquet written as a folder of a single part file."""
    df.coalesce(1).write.mode("overwrite").parquet(path)
    return path


@pytest.fixture()
def delivery(spark, tmp_path):
    """Two years of yellow, one month of green, and files that are no Parquet."""
    base = str(tmp_path / "trips")
    for year, month in ((2023, 12), (2024, 1), (2024, 2)):
        one_file(
            spark.range(month).toDF("n"), f"{base}/{year}/yellow/yellow_tripdata_{year}-{month}.parquet"
        )
    one_file(spark.range(5).toDF("n"), f"{base}/2024/green/green_tripdata_2024-01.parquet")
    (tmp_path / "trips/2024/green/notes.txt").write_text("not data")
    return base


def test_tree_scan_takes_parquet_at_any_depth(spark, delivery):
    assert read_tree(spark, delivery).count() == 12 + 1 + 2 + 5
    assert read_tree(spark, delivery, "n bigint").columns == ["n"]


def test_several_paths_are_one_scan(spark, delivery):
    paths = [i.path for i in list_inputs(spark, f"{delivery}/2024/yellow/*.parquet")]
    assert read_parquet(spark, *paths).count() == 3
    assert read_parquet(spark, *paths, schema=spark.range(1).toDF("n").schema).count() == 3


def test_inputs_are_whole_months(spark, delivery):
    found = list_inputs(spark, f"{delivery}/2024/*/*.parquet")
    assert [i.path.rsplit("/", 1)[-1] for i in found] == [
        "green_tripdata_2024-01.parquet",
        "yellow_tripdata_2024-1.parquet",
        "yellow_tripdata_2024-2.parquet",
    ]
    assert all(i.sample.startswith(i.path) for i in found)
    folders = list_inputs(spark, f"{delivery}/2024/*/*.parquet", PARENT_FOLDER)
    assert [i.path for i in folders] == [i.path for i in found]
    assert list_inputs(spark, f"{delivery}/1999/*.parquet") == []


def test_missing_inputs_are_warned_about(spark, delivery, caplog):
    with caplog.at_level(logging.WARNING):
        found = find_service_inputs(spark, delivery, [2023, 2024], ["yellow", "green"])
    assert {s: len(i) for s, i in found.items()} == {"yellow": 3, "green": 1}
    assert [r.args[:2] for r in caplog.records] == [("green", "2023")]
    caplog.clear()
    assert find_service_inputs(spark, delivery, [1999], ["yellow", "green"]) == {}
    assert "no inputs at all" in caplog.records[-1].message


def test_year_and_source_of_a_path(spark):
    df = spark.createDataFrame(
        [
            ("file:/lake/2022/x/2024/green/green_tripdata_2024-01.parquet",),
            ("file:/lake/2022/x/2024/green/green_tripdata_2024-01.parquet/part-0.snappy.parquet",),
        ],
        "p string",
    )
    path = F.col("p")
    rows = df.select(year_of_path(path).alias("y"), source_of_path(path).alias("s")).collect()
    assert [tuple(r) for r in rows] == [(2024, "green_tripdata_2024-01")] * 2
    hive = df.select(
        year_of_path(F.lit("/b/green/year=2024/a.parquet"), "{base}/{service}/year={year}/*.parquet")
    )
    assert hive.first()[0] == 2024
    deep = "{base}/{year}/{service}/month=*/*.parquet"
    of = "/b/2024/green/month=01/part-0.c000.snappy.parquet"
    assert spark.range(1).select(source_of_path(F.lit(of), deep)).first()[0] == (
        "month=01-part-0.c000.snappy"
    )
    assert input_name(of, deep) == "month=01-part-0.c000.snappy"
    assert input_year(of, deep) == "2024"
    with pytest.raises(ValueError, match="year"):
        year_of_path(path, "{base}/{service}/*.parquet")


def test_scans_are_grouped_by_schema(spark, tmp_path, caplog):
    paths = {
        "a": spark.range(1).selectExpr("CAST(id AS int) AS n"),
        "b": spark.range(2).selectExpr("CAST(id AS int) AS n"),
        "c": spark.range(3).selectExpr("CAST(id AS double) AS N", "'x' AS extra"),
    }
    for name, df in paths.items():
        one_file(df, str(tmp_path / f"{name}.parquet"))
    (tmp_path / "d.parquet").write_bytes(b"no parquet at all")
    inputs = list_inputs(spark, f"{tmp_path}/*.parquet")
    with pytest.raises(Exception, match="d.parquet"):
        scan_by_schema(spark, inputs)
    found = scan_by_schema(spark, inputs, skip_unreadable=True)
    assert [i.path[-9:] for i in found.left_out] == ["d.parquet"]
    scans = found.scans
    assert [(len(s.inputs), s.df.count()) for s in scans] == [(2, 3), (1, 3)]
    assert "d.parquet" in caplog.text

    together = union_drifted([s.df for s in scans])
    assert together.dtypes == [("n", "double"), ("extra", "string")]
    rows = sorted((r.n, r.extra or "") for r in together.collect())
    assert rows == [(0.0, ""), (0.0, ""), (0.0, "x"), (1.0, ""), (1.0, "x"), (2.0, "x")]


def test_union_drifted_types(spark):
    def kinds(*types):
        frames = [spark.sql(f"SELECT CAST(NULL AS {t}) AS c") for t in types]
        return union_drifted(frames).dtypes[0][1]

    assert kinds("int", "int") == "int"
    assert kinds("int", "bigint") == "bigint"
    assert kinds("int", "float") == "double"
    assert kinds("bigint", "float") == "double"
    assert kinds("decimal(10,2)", "double") == "double"
    assert kinds("decimal(20,19)", "bigint") == "decimal(38,19)"
    assert kinds("decimal(10,2)", "decimal(8,4)") == "decimal(12,4)"
    assert kinds("timestamp", "timestamp_ntz") == "timestamp_ntz"
    assert kinds("void", "int") == "int"
    for apart in (("decimal(38,30)", "bigint"), ("int", "string"), ("date", "int")):
        with pytest.raises(DriftError, match="column c has no common type"):
            kinds(*apart)


def test_union_drifted_loses_no_digit(spark, tmp_path):
    def together(whole, floating="0.5D"):
        paths = []
        for n, value in enumerate((whole, floating)):
            paths.append(str(tmp_path / f"{abs(hash(whole))}-{n}.parquet"))
            spark.sql(f"SELECT {value} AS c, 'x' AS other").write.parquet(paths[-1])
        return union_drifted([spark.read.parquet(p) for p in paths])

    for whole in ("9007199254740992L", "-9007199254740992L", "CAST(NULL AS BIGINT)", "1L"):
        rows = together(whole)
        assert dict(rows.dtypes)["c"] == "double" and rows.count() == 2
    exact = together("CAST(1234567890123456.5 AS DECIMAL(20,1))")
    assert 1234567890123456.5 in {r.c for r in exact.collect()}
    # One more than 2^53, and more digits than a double keeps: named with its input.
    for lossy in ("9007199254740993L", "CAST(0.12345678901234567891 AS DECIMAL(30,20))"):
        with pytest.raises(DriftError, match=r"column c .*-0\.parquet"):
            together(lossy)


def test_equal_numbers_of_drifting_months_stay_equal(spark):
    frames = [spark.sql("SELECT 1L AS c"), spark.sql("SELECT 1.0D AS c")]
    assert [tuple(r) for r in union_drifted(frames).groupBy("c").count().collect()] == [(1.0, 2)]


def test_zones_have_fixed_types_and_nulls(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        "LocationID,Borough,zone,service_zone,latitude,longitude\n"
        '1,EWR,"Airport, North",EWR,40.5,-74.25\n'
        "21,Brooklyn,East,Boro Zone,,\n"
    )
    zones = read_zones(spark, str(path))
    assert zones.schema == ZONES
    rows = zones.collect()
    assert (rows[0].zone, rows[0].latitude) == ("Airport, North", 40.5)
    assert rows[1].latitude is None and rows[1].longitude is None


def test_stored_frames_keep_rows_and_schema(spark):
    df = spark.createDataFrame([(1, math.nan), (None, 2.0)], "a int, b double")
    kept = stored(df, "kept")
    assert kept.schema == df.schema
    assert kept.count() == 2
    assert all(name.startswith("file:") and "/meterline/" in name for name in kept.inputFiles())


def test_the_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_folder(spark, "x") != new_folder(spark, "x")


class Setting:
    def __init__(self, value):
        self.value = value

    def get(self, key, default=None):
        return self.value if self.value is not None else default


class Session:
    """As much of a session as the folder choice looks at."""

    def __init__(self, master, folder):
        self.conf = Setting(folder)
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app-1"})


def test_a_cluster_needs_a_shared_folder():
    assert shared_folder(Session("yarn", "hdfs:///ck/")) == "hdfs:///ck/meterline/app-1"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("spark://host:7077", None))
    local = Session("local[2]", None)
    assert shared_folder(local) == shared_folder(local)


class Reader:
    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, **arguments):
        self.calls.append((url, table, arguments))
        return "frame"


def test_jdbc_reads_are_always_split():
    session = type("S", (), {"read": Reader()})()
    with pytest.raises(ValueError, match="predicates"):
        read_jdbc(session, "jdbc:x", "t", {})
    assert read_jdbc(session, "jdbc:x", "t", {}, predicates=["a < 1", "a >= 1"]) == "frame"
    read_jdbc(session, "jdbc:x", "t", {"user": "u"}, split_on="a", low=1, high=9, parts=4)
    assert session.read.calls[1][2] == {
        "column": "a",
        "lowerBound": 1,
        "upperBound": 9,
        "numPartitions": 4,
        "properties": {"user": "u"},
    }


def test_missing_path_is_an_error_for_a_plain_read(spark, tmp_path):
    with pytest.raises(AnalysisException):
        read_parquet(spark, str(tmp_path / "none"))


def test_s3a_is_read_with_the_settings_of_the_session(spark, tmp_path, monkeypatch):
    settings = {"endpoint": "http://store:9000/", "access.key": "a", "secret.key": "b", "endpoint.region": "r"}
    for name, value in settings.items():
        spark.conf.set(f"spark.hadoop.fs.s3a.{name}", value)
    try:
        found = layers.s3_settings(spark)
    finally:
        for name in settings:
            spark.conf.unset(f"spark.hadoop.fs.s3a.{name}")
    assert found == {"access_key": "a", "secret_key": "b", "region": "r", "endpoint_override": "store:9000", "scheme": "http"}
    assert layers.s3_settings(spark) == {}

    # The store itself is stood in for by a local folder.
    one_file(spark.range(2), str(tmp_path / "bucket/a b.parquet"))
    asked = []

    def local(**how):
        asked.append(how)
        return SubTreeFileSystem(str(tmp_path), LocalFileSystem())

    monkeypatch.setattr(layers, "S3FileSystem", local)
    paths = ["s3a://bucket/a%20b.parquet", "s3a://bucket/none.parquet", (tmp_path / "bucket/a b.parquet").as_uri()]
    (marks,) = layers._footer_marks(found)(iter([pd.DataFrame({"path": paths})]))
    first, absent, same = marks["mark"]
    assert first == same and absent is None and asked[0] == found
