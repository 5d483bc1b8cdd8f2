"""Paths of a delivery's files are decoded only where they have escapes."""

from pyspark.sql import functions as F

from meterline.sources.layers import source_of_path


def test_paths_without_escapes_are_not_decoded(spark):
    """Decoding is one branch; a path without escapes takes the other, as it is."""
    paths = ["/b/green/2024/a.parquet", "/b/green/2024/a+b.parquet", "/b/green/2024/a%20b%2Bc+d%25.parquet"]
    found = spark.createDataFrame([(p,) for p in paths], "path string").select(source_of_path(F.col("path")))
    assert [row[0] for row in found.collect()] == ["a", "a+b", "a b+c+d%"]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("CASE WHEN") < plan.lower().index("url")
