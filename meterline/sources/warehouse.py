"""Reading stored warehouse tables, from the catalog or over JDBC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schemas import STAGING, STAR
from ..sinks.versions import current, read_version


def read_staging(spark: SparkSession, table: str = "staging.trips") -> DataFrame:
    """The 25 staging columns of the stored table, without its partitioning columns."""
    return spark.table(table).select(*STAGING.fieldNames())


def read_star(spark: SparkSession, schema: str = "production") -> dict[str, DataFrame]:
    """The seven stored star tables by name.

    Of a star with versions all seven are of the version that is valid now, also if
    another one becomes valid between two reads.
    """
    at = current(spark, schema)
    if at is not None:
        return read_version(spark, schema, at)
    return {name: spark.table(f"{schema}.{name}") for name in STAR}


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    predicates: Sequence[str] | None = None,
    split_on: str | None = None,
    low: str | int | None = None,
    high: str | int | None = None,
    parts: int = 64,
) -> DataFrame:
    """A JDBC table read by several tasks.

    Give either ``predicates`` (one per task, together covering every row) or a column
    with its range. Without them the table would pass through one task, so that is
    refused.
    """
    if predicates:
        return spark.read.jdbc(
            url, table, predicates=list(predicates), properties=dict(properties)
        )
    if split_on is None or low is None or high is None:
        raise ValueError("give predicates, or split_on with low and high")
    return spark.read.jdbc(
        url,
        table,
        column=split_on,
        lowerBound=low,
        upperBound=high,
        numPartitions=parts,
        properties=dict(properties),
    )
