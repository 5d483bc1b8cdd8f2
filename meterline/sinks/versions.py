"""A star whose seven tables change at one moment.

The rows are stored in a schema of their own, in tables partitioned by the build that
wrote them. One view, ``current``, names the builds that are valid: one for the
dimensions, one for each year of delivery and service of the fact. The seven tables that
readers see are views over the stored ones that ask ``current``. Replacing that one view
is the switch: before it readers have the old star as a whole, after it the new one. Rows
of earlier builds stay until ``drop_old_builds``, so a query that began before the switch
ends on what it began with. A build that stops leaves rows that no reader sees.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..schemas import STAR
from ..session import unsorted_folders
from .tables import create_schema

FACT = "factTrip"
# Partition columns beside the build; the service is one of the fact's own columns.
FACT_PARTITIONS = ("batch_year", "service_type_id")


@dataclass(frozen=True)
class Current:
    """The valid build of the dimensions, and of each ``year/service`` of the fact.

    ``made_from`` marks the staging rows that each part of the fact was built from.
    """

    dims: str
    fact: Mapping[str, str] = field(default_factory=dict)
    made_from: Mapping[str, str] = field(default_factory=dict)


def store_schema(production: str) -> str:
    return f"{production}_store"


def new_build() -> str:
    """A name that sorts by time and is never used again."""
    return f"{datetime.now(timezone.utc):%Y%m%d%H%M%S%f}_{uuid.uuid4().hex[:8]}"


def part_name(year: object, service_type: object) -> str:
    return f"{year}/{service_type}"


def create_store(
    spark: SparkSession, production: str, location: str | None = None, *, row_group_bytes: int | None = None
) -> None:
    """The stored tables, where they are missing.

    ``row_group_bytes`` is the size of what a scan can skip within a file (128 MB if not
    given).
    """
    options = f"OPTIONS ('parquet.block.size' = '{row_group_bytes}') " if row_group_bytes else ""
    store = store_schema(production)
    create_schema(spark, store, location=location)
    for name, schema in STAR.items():
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        more, by = ", build string", "build"
        if name == FACT:
            more, by = f"{more}, batch_year int", f"build, {', '.join(FACT_PARTITIONS)}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {store}.{name} ({columns}{more}) "
            f"USING parquet {options}PARTITIONED BY ({by})"
        )


# Order of a clustered fact within its year and service: reports ask for times, then places.
CLUSTERED_BY = ("pickup_datetime", "pickup_location_id")


def store_rows(
    df: DataFrame, production: str, name: str, build: str, *, clustered: bool = False
) -> DataFrame:
    """Add the rows of a build to a stored table; returns them as stored.

    ``clustered`` ranges the fact by time and place first, so that the statistics of files
    and row groups tell a scan of some days what to skip. It is one shuffle; a hot place
    is spread over as many ranges as its times fill.
    """
    spark = df.sparkSession
    table = f"{store_schema(production)}.{name}"
    columns = spark.table(table).columns
    rows = df.withColumn("build", F.lit(build)).select(*columns)
    if clustered and name == FACT:
        # The writer wants the rows of a folder together; with the build in the order it
        # takes them as they are.
        order = ["build", *FACT_PARTITIONS, *CLUSTERED_BY]
        rows = rows.repartitionByRange(*order[1:]).sortWithinPartitions(*order)
    if clustered and name == FACT:
        rows.write.insertInto(table)
    else:
        with unsorted_folders(spark):
            rows.write.insertInto(table)
    stored = spark.table(table).where(F.col("build") == build)
    return stored.select(*STAR[name].fieldNames())


def current(spark: SparkSession, production: str) -> Current | None:
    """What is valid now; None before the first switch."""
    view = f"{store_schema(production)}.current"
    if not spark.catalog.tableExists(view):
        return None
    row = spark.table(view).first()
    return Current(row.dims, dict(row.fact), dict(row.made_from))


def switch(spark: SparkSession, production: str, to: Current) -> None:
    """Make the builds of ``to`` valid, all at the same moment."""
    store = store_schema(production)

    def literal(pairs: Mapping[str, str]) -> str:
        texts = ", ".join(f"'{key}', '{value}'" for key, value in sorted(pairs.items()))
        return f"CAST(map({texts}) AS map<string, string>)"

    spark.sql(
        f"CREATE OR REPLACE VIEW {store}.current AS SELECT '{to.dims}' AS dims, "
        f"{literal(to.fact)} AS fact, {literal(to.made_from)} AS made_from"
    )
    there = {t.name.lower(): t.tableType for t in spark.catalog.listTables(production)}
    for name, schema in STAR.items():
        kind = there.get(name.lower())
        if kind == "VIEW":
            continue
        if kind:
            spark.sql(f"DROP TABLE {production}.{name}")
        valid = f"build = (SELECT dims FROM {store}.current)"
        if name == FACT:
            part = " || '/' || ".join(FACT_PARTITIONS)
            valid = f"build = try_element_at((SELECT fact FROM {store}.current), {part})"
        columns = ", ".join(f"`{c}`" for c in schema.fieldNames())
        spark.sql(f"CREATE VIEW {production}.{name} AS SELECT {columns} FROM {store}.{name} WHERE {valid}")


def _valid(name: str, at: Current) -> Column:
    if name != FACT:
        return F.col("build") == at.dims
    if not at.fact:
        return F.lit(False)
    pairs = [F.lit(x) for part in sorted(at.fact.items()) for x in part]
    part = F.concat_ws("/", *[F.col(c).cast("string") for c in FACT_PARTITIONS])
    return F.col("build") == F.try_element_at(F.create_map(*pairs), part)


def read_version(spark: SparkSession, production: str, at: Current) -> dict[str, DataFrame]:
    """The seven tables of one version, whatever is switched later."""
    store = store_schema(production)
    return {
        name: spark.table(f"{store}.{name}").where(_valid(name, at)).select(*schema.fieldNames())
        for name, schema in STAR.items()
    }


def drop_old_builds(spark: SparkSession, production: str, *, keep: Current | None = None) -> int:
    """Drop the partitions that neither the valid version nor ``keep`` uses; returns how many.

    Call it when no query runs on an older version any more, and no build is under way.
    """
    now = current(spark, production)
    if now is None:
        return 0
    versions = [v for v in (now, keep) if v is not None]
    store, dropped = store_schema(production), 0
    for name in STAR:
        for row in spark.sql(f"SHOW PARTITIONS {store}.{name}").collect():
            values = dict(part.split("=", 1) for part in row[0].split("/"))
            if name == FACT:
                part = part_name(*[values[c] for c in FACT_PARTITIONS])
                used = {v.fact.get(part) for v in versions}
            else:
                used = {v.dims for v in versions}
            if values["build"] not in used:
                spec = ", ".join(f"{c}='{v}'" for c, v in values.items())
                spark.sql(f"ALTER TABLE {store}.{name} DROP PARTITION ({spec})")
                dropped += 1
    return dropped
