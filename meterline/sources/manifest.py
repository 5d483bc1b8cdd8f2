"""What a layer holds and what it was made from, so that a run works on changes only.

Every service folder of a layer keeps a log of its sources: the files a source was made
from (path, size, modification time, schema), the files it is stored in with their schema,
and a version, which is a digest of all that its rows depend on. A run compares the log
with a listing. A source is up to date if its version is the same and its folder holds
the very files that were logged; Spark names the files of every write anew, so a folder
that was changed by hand, or half written by a run that stopped, does not pass.

The log is appended to when the rows are stored. A run that stops in between leaves the
earlier entry, and the next run works on the source again. Only names, sizes, times and
distinct schemas come to the driver, never rows.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

# Spark leaves out folders whose names begin like this when it reads a layer.
FOLDER = "_manifest"
LOG = (
    "run string, batch_year string, source string, state string, version string, "
    "role string, path string, size long, modified long, mark string, schema string"
)
STORED, EMPTY, LEFT_OUT = "stored", "empty", "left_out"
# A row is a file that a source was made from, one that holds it, or a schema and its mark.
_MADE_FROM, _HELD_IN, _SCHEMA = "input", "stored", "schema"

Key = tuple[str, str]  # year of delivery and source


@dataclass(frozen=True)
class File:
    """A file with the schema found in it, if it is known."""

    path: str
    size: int | None = None
    modified: int | None = None
    schema: str | None = None


@dataclass(frozen=True)
class Entry:
    """A source of a layer: its version, what it was made from and where it is stored."""

    key: Key
    version: str
    made_from: tuple[File, ...] = ()
    held_in: tuple[File, ...] = ()
    state: str = STORED


@dataclass
class Manifest:
    """The last entry of each source of a service folder."""

    entries: Mapping[Key, Entry] = field(default_factory=dict)

    def holds(self, key: Key, version: str, files: Iterable[str]) -> bool:
        """Whether a source is stored in this version, in the files its folder has now."""
        entry = self.entries.get(key)
        if entry is None or entry.version != version:
            return False
        return {f.path for f in entry.held_in} == set(files)

    def stored_schemas(self) -> dict[str, str]:
        """The schema of each stored file, where the writing run knew it."""
        return {f.path: f.schema for e in self.entries.values() for f in e.held_in if f.schema}

    def input_schemas(self, files: Mapping[str, tuple[int, int]]) -> dict[str, str]:
        """Schemas of those input files that are as they were: of equal size and time."""
        return {
            f.path: f.schema
            for e in self.entries.values()
            for f in e.made_from
            if f.schema and files.get(f.path) == (f.size, f.modified)
        }


def digest(*parts: object) -> str:
    return hashlib.sha256("\n".join(map(repr, parts)).encode()).hexdigest()


def _path(layer: str, service: str) -> str:
    return f"{layer}/service={service}/{FOLDER}"


def log_of(spark: SparkSession, layer: str, service: str) -> DataFrame | None:
    """All rows ever logged; None if there are none."""
    try:
        return spark.read.schema(LOG).parquet(_path(layer, service))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_manifest(spark: SparkSession, layer: str, service: str) -> Manifest:
    """The last entries; sources that were left out since keep the one before."""
    log = log_of(spark, layer, service)
    if log is None:
        return Manifest()
    rows = log.where((F.col("state") != LEFT_OUT) | (F.col("role") == _SCHEMA)).collect()
    schemas = {r.mark: r.schema for r in rows if r.role == _SCHEMA}
    last: dict[Key, str] = {}
    for r in rows:
        if r.role != _SCHEMA:
            key = (r.batch_year, r.source)
            last[key] = max(r.run, last.get(key, r.run))
    found: dict[Key, dict[str, list[File]]] = {}
    heads = {}
    for r in rows:
        key = (r.batch_year, r.source)
        if r.role == _SCHEMA or r.run != last[key]:
            continue
        heads[key] = (r.version, r.state)
        parts = found.setdefault(key, {_MADE_FROM: [], _HELD_IN: []})
        if r.path is not None:
            parts[r.role].append(File(r.path, r["size"], r.modified, schemas.get(r.mark)))
    return Manifest(
        {
            key: Entry(key, heads[key][0], tuple(p[_MADE_FROM]), tuple(p[_HELD_IN]), heads[key][1])
            for key, p in found.items()
        }
    )


def write_manifest(spark: SparkSession, layer: str, service: str, entries: Sequence[Entry]) -> None:
    """Append the entries of a run, in one commit. A schema is written once, however many files have it."""
    if not entries:
        return
    run = f"{time.time_ns():020d}"
    rows, schemas = [], {}
    for entry in entries:
        head = (run, *entry.key, entry.state, entry.version)
        files = [(_MADE_FROM, f) for f in entry.made_from] + [(_HELD_IN, f) for f in entry.held_in]
        # A source without files still has its version.
        for role, f in files or [(_MADE_FROM, File(None))]:
            mark = digest(f.schema) if f.schema else None
            schemas[mark] = f.schema
            rows.append((*head, role, f.path, f.size, f.modified, mark, None))
    schemas.pop(None, None)
    rows += [(run, *(None,) * 4, _SCHEMA, *(None,) * 3, mark, text) for mark, text in schemas.items()]
    log = spark.createDataFrame(rows, LOG).coalesce(1)
    log.write.mode("append").parquet(_path(layer, service))
