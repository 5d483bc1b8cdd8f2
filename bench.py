"""Times the stages of a run and single queries; prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from meterline_checks import queries as q  # noqa: E402
from meterline.operators.quality import star_tests  # noqa: E402
from meterline.operators.star import revenue_by_vendor  # noqa: E402
from meterline.plans import pipeline  # noqa: E402
from meterline.session import local_session, new_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Run after the stages, each from the landed files to its last row.
QUERIES = (
    "clean_trips",
    "staging_trips",
    "fact_trip",
    "fact_revenue_by_vendor",
    "expectation_suite",
    "null_profile",
    "test_relationships",
    "surrogate_keys",
)


def run(df) -> None:
    """All rows of ``df``, without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(
        cores=CPUS,
        shuffle_partitions=int(CPUS),
        spark__driver__memory="8g",
        spark__sql__maxConcurrentOutputFileWriters="64",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, step):
        start = time.perf_counter()
        out = step()
        seconds[name] = round(time.perf_counter() - start, 3)
        return out

    # Deriving trips from the order tables is no part of the work that is measured.
    base, layout = timed("derive_trips", lambda: q.landing(spark, SF_DIR))
    setup = seconds.pop("derive_trips")
    years = q.delivered_years(spark, SF_DIR)
    zones = q.zones(spark, SF_DIR)
    lake, tag = new_folder(spark, "bench"), uuid.uuid4().hex[:12]
    warehouse = pipeline.Warehouse(f"staging_{tag}", f"production_{tag}", f"{lake}/warehouse")
    raw, clean = f"{lake}/raw", f"{lake}/clean"

    timed("load_raw", lambda: pipeline.load_raw(spark, base, raw, years, layout=layout))
    timed("clean_layer", lambda: pipeline.clean_layer(spark, raw, clean, zones))
    timed(
        "convert_layer",
        lambda: pipeline.convert_layer(spark, clean, f"{lake}/orc", fmt="orc"),
    )
    timed("reset_warehouse", lambda: pipeline.reset_warehouse(spark, warehouse))
    timed("load_staging", lambda: pipeline.load_staging(spark, clean, warehouse))
    timed("validate_staging", lambda: run(pipeline.validate_staging(spark, warehouse)))
    star = timed("load_star", lambda: pipeline.load_star(spark, warehouse))
    timed("star_tests", lambda: run(star_tests(star)))
    timed("revenue_report", lambda: run(revenue_by_vendor(star)))
    for name in QUERIES:
        timed(f"query_{name}", lambda name=name: run(q.QUERIES[name](spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "pipeline stages and headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "setup_sec": setup,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
