"""Warehouse schemas and tables in the session's catalog."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def create_schema(spark: SparkSession, name: str, *, location: str | None = None) -> None:
    """Create a schema unless it is there."""
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{at}")


def reset_schema(
    spark: SparkSession, name: str, *, location: str | None = None, cascade: bool = False
) -> None:
    """Drop and create a schema; one that still has tables is only dropped on request."""
    spark.sql(f"DROP DATABASE IF EXISTS `{name}` {'CASCADE' if cascade else 'RESTRICT'}")
    create_schema(spark, name, location=location)


def create_table(
    spark: SparkSession,
    table: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    replace: bool = True,
) -> None:
    """Create an empty table with declared types; drop an earlier one, or keep it.

    Overwriting a partitioned table replaces the partitions that rows are given for.
    """
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ""
    if partition_by:
        by = " OPTIONS ('partitionOverwriteMode' = 'dynamic')"
        by += f" PARTITIONED BY ({', '.join(partition_by)})"
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING {fmt}{by}")


def save_table(df: DataFrame, table: str, *, fmt: str = "parquet") -> DataFrame:
    """Replace a table by the rows of ``df`` and return it as stored.

    The rows are written beside the table first, so a failed write leaves the old one.
    """
    spark = df.sparkSession
    beside = name_beside(table)
    try:
        df.write.format(fmt).saveAsTable(beside)
        exchange_tables(spark, {table: beside})
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {beside}")
    return spark.table(table)


def name_beside(table: str) -> str:
    """A new name in the schema of ``table``."""
    return f"{table}__{uuid.uuid4().hex}"


def exchange_tables(spark: SparkSession, beside: Mapping[str, str]) -> None:
    """Put finished tables, unpartitioned ones, in the place of the tables they stand for.

    Each exchange is a drop and a rename in the catalog, without any rows.
    """
    for table, new in beside.items():
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {new} RENAME TO {table}")
