"""The zone lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import ZONES


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header; types are given, so the file is not read to guess them.

    An empty cell is null.
    """
    return spark.read.schema(ZONES).csv(path, header=True)
