"""Session helpers: a small local session and the shared folder for stored steps."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_roots: dict[str, str] = {}

# Files that a task may have open at once before it sorts its rows by folder instead.
OPEN_FILES = 32
_OPEN_FILES_SETTING = "spark.sql.maxConcurrentOutputFileWriters"
_writing: dict[str, int] = {}
_writing_lock = threading.Lock()


def local_session(cores: str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and the bench; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("meterline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may go without the setting; it then gets a fresh
    temporary folder. On a cluster a machine-local folder would lose stored
    steps together with the machine, so a missing setting is an error there.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        if app not in _local_roots:
            _local_roots[app] = tempfile.mkdtemp(prefix="meterline-")
        root = _local_roots[app]
    return f"{root.rstrip('/')}/meterline/{app}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier step has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def unsorted_folders(spark: SparkSession) -> Iterator[None]:
    """Writes into partition folders while a task holds a file open for each of them.

    Without it every task sorts its whole rows by folder first, and what does not fit in
    its memory is spilled. A task that meets more than ``OPEN_FILES`` folders sorts the
    rest. A session that has its own setting keeps it; writes may run side by side.
    """
    app = spark.sparkContext.applicationId
    with _writing_lock:
        if app in _writing:
            _writing[app] += 1
        elif int(spark.conf.get(_OPEN_FILES_SETTING, "0")) == 0:
            spark.conf.set(_OPEN_FILES_SETTING, str(OPEN_FILES))
            _writing[app] = 1
        ours = app in _writing
    try:
        yield
    finally:
        with _writing_lock:
            if ours:
                _writing[app] -= 1
                if not _writing[app]:
                    del _writing[app]
                    spark.conf.unset(_OPEN_FILES_SETTING)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written files.

    Used where several later steps read the same frame. The files survive lost
    executors, cut the lineage, and still allow column pruning and pushed filters.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
