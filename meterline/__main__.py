"""Stages from the command line: ``spark-submit run.py STAGE`` or ``python -m meterline STAGE``.

The session's settings (master, file systems, catalog) come from the caller's Spark
configuration. Stages in separate applications need a catalog that outlives them.
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from .operators.profile import null_profile, preview
from .operators.quality import STAGING_SUITE, star_tests, suite_from_json
from .plans import pipeline
from .schemas import SERVICES
from .sources.layers import LAYOUT
from .sources.warehouse import read_star
from .sources.zones import read_zones


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser("meterline", description=__doc__)
    stages = parser.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str, *needs: str) -> None:
        one = stages.add_parser(name, help=text)
        one.add_argument("--years", type=int, nargs="+", required="years" in needs)
        one.add_argument("--skip-failed", action="store_true", help="log failed inputs, go on")
        if "base" in needs:
            one.add_argument("--base", required=True, help="folder of the delivery")
            one.add_argument("--layout", default=LAYOUT)
            one.add_argument("--services", nargs="+", default=list(SERVICES), choices=SERVICES)
        if "lake" in needs:
            one.add_argument("--lake", required=True, help="folder of the raw and clean layers")
        if "zones" in needs:
            one.add_argument("--zones", required=True, help="CSV zone lookup")
        if "warehouse" in needs:
            one.add_argument("--staging", default="staging")
            one.add_argument("--production", default="production")
            one.add_argument("--root", help="folder of both schemas, if not the catalog's")
            one.add_argument("--cascade", action="store_true", help="drop schemas with tables")
            one.add_argument("--append", action="store_true", help="add to staging")
            one.add_argument("--suite", help="JSON file with expectations")
            one.add_argument("--results", help="folder to keep the validation report in")
            one.add_argument("--clustered", action="store_true", help="order the fact by time and place")
            one.add_argument("--mirror", action="store_true", help="empty what is no longer delivered")
        if "format" in needs:
            one.add_argument("--format", default="delta")
            one.add_argument("--target", required=True)
        if "jdbc" in needs:
            one.add_argument("--url", required=True)
            one.add_argument("--table", required=True)
            one.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")
            one.add_argument("--mode", default="append", choices=["append", "overwrite"])
        if "path" in needs:
            one.add_argument("--path", required=True)

    stage("load-raw", "bring a delivery into the raw layer", "years", "base", "lake")
    stage("clean", "clean and enrich the raw layer", "lake", "zones")
    stage("convert", "rewrite the clean layer in another format", "lake", "format")
    stage("create", "drop and create schemas and the staging table", "warehouse")
    stage("load-staging", "group clean trips into the staging table", "lake", "warehouse")
    stage("load-jdbc", "group clean trips into a JDBC table", "lake", "jdbc")
    stage("validate", "hold the staging table to its suite", "warehouse")
    stage("star", "build dimensions and fact", "warehouse")
    stage("test-star", "test the star schema", "warehouse")
    stage("update", "work on what changed since the last run", "years", "base", "lake", "zones", "warehouse")
    stage("all", "every stage in order", "years", "base", "lake", "zones", "warehouse")
    stage("inspect", "schema, first rows and null counts of a Parquet path", "path")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> int:
    """Run one stage; 1 if a check did not hold or an input was left out, else 0."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    a = arguments(argv)
    spark = SparkSession.builder.appName(f"meterline {a.stage}").getOrCreate()
    # Calendar columns must not depend on the cluster's setting.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    raw, clean = (f"{a.lake}/raw", f"{a.lake}/clean") if hasattr(a, "lake") else (None, None)
    options = {"years": a.years, "skip_failed": a.skip_failed}
    warehouse = None
    left_out: list[str] = []
    if hasattr(a, "root"):
        warehouse = pipeline.Warehouse(a.staging, a.production, a.root)

    def zones():
        return read_zones(spark, a.zones)

    def suite():
        if not a.suite:
            return STAGING_SUITE
        text = "\n".join(r.value for r in spark.read.text(a.suite, wholetext=True).collect())
        return suite_from_json(text)

    match a.stage:
        case "load-raw":
            left_out += pipeline.load_raw(
                spark, a.base, raw, services=a.services, layout=a.layout, **options
            )
        case "clean":
            left_out += pipeline.clean_layer(spark, raw, clean, zones(), **options)
        case "convert":
            left_out += pipeline.convert_layer(
                spark,
                clean,
                a.target,
                fmt=a.format,
                years=a.years,
                skip_unreadable=a.skip_failed,
            )
        case "create":
            pipeline.reset_warehouse(spark, warehouse, cascade=a.cascade)
        case "load-staging":
            pipeline.load_staging(
                spark, clean, warehouse, append=a.append, left_out=left_out, **options
            )
        case "load-jdbc":
            properties = dict(p.split("=", 1) for p in a.property)
            pipeline.load_staging_jdbc(
                spark, clean, a.url, a.table, properties, mode=a.mode, years=a.years
            )
        case "validate":
            return _report(
                pipeline.validate_staging(spark, warehouse, suite(), results=a.results)
            )
        case "star":
            pipeline.load_star(spark, warehouse, clustered=a.clustered)
        case "update":
            star = pipeline.run_changed(
                spark,
                a.base,
                a.lake,
                zones(),
                warehouse,
                a.years,
                services=a.services,
                layout=a.layout,
                mirror=a.mirror,
                skip_failed=a.skip_failed,
                left_out=left_out,
                clustered=a.clustered,
            )
            return max(_report(star_tests(star)), _named(left_out))
        case "test-star":
            return _report(star_tests(read_star(spark, warehouse.production)))
        case "all":
            out = pipeline.run_all(
                spark,
                a.base,
                a.lake,
                zones(),
                warehouse,
                a.years,
                services=a.services,
                layout=a.layout,
                reset=a.cascade,
                skip_failed=a.skip_failed,
                left_out=left_out,
            )
            held = max(_report(out["staging_report"]), _report(out["star_report"]))
            return max(held, _named(left_out))
        case "inspect":
            df = spark.read.parquet(a.path)
            df.printSchema()
            preview(df).show()
            null_profile(df).show()
    return _named(left_out)


def _named(left_out: list[str]) -> int:
    """Print what was left out; 1 if there is any."""
    for path in left_out:
        print("left out", path, sep="\t")
    return 1 if left_out else 0


def _report(report) -> int:
    """Print a report (one row per check) and say whether every check held."""
    rows = report.collect()
    for row in rows:
        print(*row, sep="\t")
    return 0 if all(row.success for row in rows) else 1


if __name__ == "__main__":
    raise SystemExit(main())
