"""Following a delivery: files are taken into the raw layer as they come."""

from __future__ import annotations

import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SERVICES
from ..sources.layers import LAYOUT, delivery_pattern, input_year, list_inputs, literal, unit_of
from .pipeline import load_inputs

# Fixed value: the columns of Spark's source that lists files. The content is never read.
ARRIVALS = "path string, modificationTime timestamp, length long, content binary"


def follow_delivery(
    spark: SparkSession,
    base: str,
    raw: str,
    checkpoint: str,
    *,
    services: Sequence[str] = tuple(SERVICES),
    layout: str = LAYOUT,
    files_per_batch: int | None = None,
    skip_failed: bool = False,
) -> list[str]:
    """Load what has arrived since the last call, then return; the inputs left out.

    A stream of each service watches the names of all years' files. A batch of new names
    stands for its inputs, which are listed as they are now and loaded as ``load_raw``
    would: a source with a further part is replaced as a whole. The checkpoint remembers
    the names that are done. A call that stops within a batch has it again in the next
    one, where the manifest passes over what was loaded, so every file counts once.

    A file that is replaced under its name is no arrival; ``load_raw`` finds those.
    """
    left_out: list[str] = []

    def follow(service: str) -> None:
        names = spark.readStream.format("binaryFile").schema(ARRIVALS)
        names = names.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        if files_per_batch:
            names = names.option("maxFilesPerTrigger", files_per_batch)

        def take(batch: DataFrame, number: int) -> None:
            arrived = {re.match(unit_of(layout), row.path).group(1) for row in batch.collect()}
            if not arrived:
                return
            end = "/*.parquet" if layout.endswith("/") else ""
            found = list_inputs(spark, [literal(path) + end for path in sorted(arrived)], unit_of(layout), stats=True)
            years = sorted({input_year(item.path, layout) for item in found})
            failed = load_inputs(spark, raw, service, found, years, layout=layout, skip_failed=skip_failed)
            left_out.extend(item.path for item in failed)

        pattern = delivery_pattern(base, service, "*", layout)
        query = (
            names.load(pattern)
            .select("path")
            .writeStream.foreachBatch(take)
            .option("checkpointLocation", f"{checkpoint}/{service}")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()

    with ThreadPoolExecutor(max(len(services), 1)) as pool:
        list(pool.map(follow, services))
    return left_out
