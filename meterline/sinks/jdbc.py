"""Loading a relational warehouse."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    mode: str = "append",
    rows_per_insert: int = 10_000,
    writers: int | None = None,
) -> None:
    """Write rows over JDBC, each partition in its own transaction.

    As many connections are open as tasks run at a time, ``writers`` at most if given;
    that merges partitions and leaves no row out. A task whose executor is lost
    after it committed runs again, so appended rows can come twice; load into an empty
    batch table (``mode="overwrite"``) and exchange it in the database where that
    matters, or use the catalog table, which is replaced as a whole.
    """
    settings = {"batchsize": str(rows_per_insert), **properties}
    if writers is not None:
        settings["numPartitions"] = str(writers)
    df.write.jdbc(url=url, table=table, mode=mode, properties=settings)
