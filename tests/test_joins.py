import pytest
from pyspark.sql import functions as F

from meterline.operators.joins import fits_broadcast, lookup_join


@pytest.fixture()
def sides(spark):
    """A third of all rows has key 7; one key is null, one is unknown, one lookup is double."""
    large = spark.range(0, 3000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, 7)
        .when(F.col("id") % 1000 == 1, None)
        .otherwise(F.col("id") % 50)
        .cast("int")
        .alias("k"),
        "id",
    )
    lookup = spark.range(0, 40).select(F.col("id").cast("int").alias("k"), F.lit("a").alias("v"))
    return large, lookup.unionAll(lookup.where("k = 3").withColumn("v", F.lit("b")))


def test_shuffled_join_equals_broadcast_join(sides):
    large, lookup = sides
    wide = lookup_join(large, lookup, "k", small=False)
    narrow = lookup_join(large, lookup, "k", small=True)
    assert wide.columns == narrow.columns
    assert sorted(wide.collect()) == sorted(narrow.collect())


def test_a_hot_key_is_split_wherever_its_rows_lie(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        # The key's rows lie in every fourth input partition only.
        large = spark.range(0, 80_000, numPartitions=8).select(
            F.when(F.spark_partition_id() % 4 == 0, 7).otherwise(F.col("id") % 500).cast("int").alias("k"),
            F.md5(F.col("id").cast("string")).alias("v"),
        )
        lookup = spark.range(0, 500).select(F.col("id").cast("int").alias("k"))
        joined = lookup_join(large, lookup, "k", small=False)
        placed = joined.select("k", "v", F.spark_partition_id().alias("task")).collect()
        assert len({r.task for r in placed if r.k == 7}) > 1
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_size_is_checked(sides):
    _, lookup = sides
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=40)
    assert fits_broadcast(lookup, max_bytes=41 * 17) and not fits_broadcast(lookup, max_bytes=41 * 17 - 1)
    assert fits_broadcast(lookup.limit(0), max_bytes=0)


def test_wide_rows_are_no_small_lookup(spark):
    few = spark.range(3).select("id", F.repeat(F.lit("x"), 1000).alias("text"), F.array(F.lit(1)).alias("list"))
    assert not fits_broadcast(few, max_bytes=3000) and fits_broadcast(few, max_bytes=3200)
    assert fits_broadcast(few.withColumns({"text": F.lit(None), "list": F.lit(None)}), max_bytes=3 * 24)


def test_join_on_several_keys(spark):
    left = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "a int, b int, c string")
    right = spark.createDataFrame([(1, 2, "r")], "a int, b int, d string")
    for small in (True, False):
        rows = lookup_join(left, right, ["a", "b"], small=small).collect()
        assert [tuple(r) for r in rows] == [(1, 2, "y", "r")]
