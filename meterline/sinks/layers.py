"""Writing and converting file layers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import unsorted_folders


def write_layer(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    fmt: str = "parquet",
    only_given_partitions: bool = True,
    compact: bool = False,
    options: Mapping[str, str] | None = None,
) -> None:
    """Overwrite a layer, or only those of its partitions that ``df`` has rows for.

    Running the same input again replaces its earlier output. Each task writes its own
    rows without a shuffle; ``compact`` adds one that merges small files and splits
    large ones, so no partition value ever has to fit in one task.
    """
    if compact:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode("overwrite").options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if only_given_partitions:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    with unsorted_folders(df.sparkSession):
        writer.save(path)
