import pytest
from pyspark.errors import AnalysisException

from meterline.schemas import STAGING_AS_DECLARED
from meterline.sinks.jdbc import append_jdbc
from meterline.sinks.layers import write_layer
from meterline.sinks.tables import create_table, reset_schema, save_table


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_only_given_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "layer")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "v int, p string")
    again = spark.createDataFrame([(3, "b")], "v int, p string")
    write_layer(first, path, partition_by=["p"])
    write_layer(again, path, partition_by=["p"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]
    write_layer(again, path, partition_by=["p"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (3, "b")]
    write_layer(again, path, partition_by=["p"], only_given_partitions=False)
    assert rows(spark.read.parquet(path)) == [(3, "b")]


def test_plain_overwrite(spark, tmp_path):
    path = str(tmp_path / "plain")
    write_layer(spark.range(3).toDF("n"), path)
    write_layer(spark.range(2).toDF("n"), path)
    assert spark.read.parquet(path).count() == 2


def test_compact_merges_small_files(spark, tmp_path):
    df = spark.range(0, 1000, numPartitions=16).selectExpr("id AS v", "id % 2 AS p")
    write_layer(df, str(tmp_path / "many"), partition_by=["p"])
    write_layer(df, str(tmp_path / "few"), partition_by=["p"], compact=True)
    many = spark.read.parquet(str(tmp_path / "many"))
    few = spark.read.parquet(str(tmp_path / "few"))
    assert len(many.inputFiles()) == 32
    assert len(few.inputFiles()) == 2
    assert rows(many) == rows(few)


def test_other_formats(spark, tmp_path):
    path = str(tmp_path / "orc")
    write_layer(spark.range(3).toDF("n"), path, fmt="orc")
    assert spark.read.orc(path).count() == 3


def test_delta_needs_its_jar(spark, tmp_path):
    try:
        spark.range(1).write.format("delta").save(str(tmp_path / "probe"))
    except Exception as error:
        assert "delta" in str(error).lower()
        with pytest.raises(Exception, match="(?i)delta"):
            write_layer(spark.range(1).toDF("n"), str(tmp_path / "d"), fmt="delta")
    else:
        write_layer(spark.range(1).toDF("n"), str(tmp_path / "d"), fmt="delta")
        assert spark.read.format("delta").load(str(tmp_path / "d")).count() == 1


def test_reset_schema_refuses_to_lose_tables(spark, tmp_path):
    reset_schema(spark, "wh_reset", location=str(tmp_path / "wh"))
    save_table(spark.range(2).toDF("n"), "wh_reset.t")
    with pytest.raises(AnalysisException):
        reset_schema(spark, "wh_reset", location=str(tmp_path / "wh"))
    assert spark.table("wh_reset.t").count() == 2
    reset_schema(spark, "wh_reset", location=str(tmp_path / "wh"), cascade=True)
    assert spark.catalog.listTables("wh_reset") == []
    spark.sql("DROP DATABASE wh_reset")


def test_declared_table(spark, tmp_path):
    reset_schema(spark, "wh_ddl", location=str(tmp_path / "wh"))
    create_table(spark, "wh_ddl.trips", STAGING_AS_DECLARED)
    table = spark.table("wh_ddl.trips")
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in STAGING_AS_DECLARED
    ]
    assert table.count() == 0
    create_table(spark, "wh_ddl.trips", STAGING_AS_DECLARED)
    spark.sql("DROP DATABASE wh_ddl CASCADE")


def test_save_table_replaces(spark, tmp_path):
    reset_schema(spark, "wh_save", location=str(tmp_path / "wh"))
    save_table(spark.range(3).toDF("n"), "wh_save.t")
    assert save_table(spark.range(1).toDF("m"), "wh_save.t").columns == ["m"]
    spark.sql("DROP DATABASE wh_save CASCADE")


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    reset_schema(spark, "wh_fail", location=str(tmp_path / "wh"))
    save_table(spark.range(3).toDF("n"), "wh_fail.t")
    with pytest.raises(Exception, match="stop here"):
        save_table(spark.range(2).selectExpr("raise_error('stop here') AS n"), "wh_fail.t")
    assert spark.table("wh_fail.t").count() == 3
    assert [t.name for t in spark.catalog.listTables("wh_fail")] == ["t"]
    # A table can be made from itself.
    assert save_table(spark.table("wh_fail.t").where("n > 0"), "wh_fail.t").count() == 2
    spark.sql("DROP DATABASE wh_fail CASCADE")


class Frame:
    """Records what would be written over JDBC."""

    def __init__(self):
        self.write = self
        self.calls = []

    def jdbc(self, **arguments):
        self.calls.append(arguments)


def test_jdbc_append_passes_the_settings_on():
    frame = Frame()
    append_jdbc(frame, "jdbc:x", "staging.trips", {"user": "u", "batchsize": "5"})
    append_jdbc(frame, "jdbc:x", "staging.trips", {}, mode="overwrite", rows_per_insert=7)
    append_jdbc(frame, "jdbc:x", "staging.trips", {}, writers=4)
    assert frame.calls[2]["properties"] == {"batchsize": "10000", "numPartitions": "4"}
    assert frame.calls[0] == {
        "url": "jdbc:x",
        "table": "staging.trips",
        "mode": "append",
        "properties": {"batchsize": "5", "user": "u"},
    }
    assert frame.calls[1]["mode"] == "overwrite"
    assert frame.calls[1]["properties"] == {"batchsize": "7"}
