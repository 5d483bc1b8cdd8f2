"""The stages of a run: raw -> clean -> staging -> star, each from stored files.

Layers are laid out as ``service=…/batch_year=…/source=…`` where ``source`` is the
monthly input a row came from. That folder is what a repeated run replaces.
"""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.cleaning import CleaningCounts, clean_trips
from ..operators.grouping import partial_sums, staging_input, staging_rows
from ..operators.joins import BROADCAST_BYTES, BROADCAST_ROWS, row_bytes
from ..operators.quality import (
    STAGING_SUITE,
    Expectation,
    check_counts,
    combined_report,
    star_tests,
    suite_to_json,
    validate,
)
from ..operators.star import NATURAL_KEYS, build_star, fact_trip
from ..schemas import CALENDAR, SERVICES, STAGING, conform
from ..session import unsorted_folders
from ..sinks.jdbc import append_jdbc
from ..sinks.layers import write_layer
from ..sinks.tables import create_schema, create_table, reset_schema
from ..sinks.versions import (
    Current,
    create_store,
    current,
    new_build,
    part_name,
    read_version,
    store_rows,
    store_schema,
    switch,
)
from ..sources.manifest import (
    EMPTY,
    LEFT_OUT,
    STORED,
    Entry,
    File,
    Key,
    Manifest,
    digest,
    read_manifest,
    write_manifest,
)
from ..sources.layers import (
    LAYOUT,
    PARENT_FOLDER,
    Input,
    Scan,
    Scans,
    find_service_inputs,
    input_name,
    input_year,
    is_input_fault,
    list_inputs,
    literal,
    scan_by_schema,
    source_of_path,
    union_drifted,
    year_of_path,
)
from ..sources.warehouse import read_staging, read_star

log = logging.getLogger(__name__)

PARTITIONS = ("batch_year", "source")  # below a folder per service
_PARTITION_TYPES = "service string, batch_year int, source string"


def load_raw(
    spark: SparkSession,
    base: str,
    raw: str,
    years: Iterable[int],
    *,
    services: Sequence[str] = tuple(SERVICES),
    layout: str = LAYOUT,
    skip_failed: bool = False,
    full: bool = False,
    mirror: bool = False,
) -> list[str]:
    """Bring delivered monthly files into the raw layer, content unchanged.

    A job per service and distinct schema takes all years; a row's year and source are
    read off the path of its file. Inputs whose files have the paths, sizes and times that
    the layer's manifest has are neither opened nor moved, unless ``full`` asks for all.
    With ``mirror``, sources of the given years that are no longer delivered are emptied
    (not if nothing at all is found). Returns the inputs that were left out.
    """
    years = list(years)
    found = find_service_inputs(spark, base, years, services, layout, stats=True)

    def load(service: str) -> list[Input]:
        return load_inputs(
            spark,
            raw,
            service,
            found.get(service, []),
            years,
            layout=layout,
            skip_failed=skip_failed,
            full=full,
            mirror=mirror,
        )

    return _side_by_side(load, services if mirror and found else found)


def load_inputs(
    spark: SparkSession,
    raw: str,
    service: str,
    inputs: Sequence[Input],
    years: Sequence[int | str],
    *,
    layout: str = LAYOUT,
    skip_failed: bool = False,
    full: bool = False,
    mirror: bool = False,
) -> list[Input]:
    """Bring inputs of one service, listed with their stats, into the raw layer."""

    def rows(scan: Scan) -> DataFrame:
        path = F.col("_metadata.file_path")
        return scan.df.withColumns(
            {"batch_year": year_of_path(path, layout), "source": source_of_path(path, layout)}
        )

    def key(item: Input) -> Key:
        return input_year(item.path, layout), input_name(item.path, layout)

    if len({key(item) for item in inputs}) < len(inputs):
        raise ValueError(f"inputs of {service} that share a year and a name: {inputs[0].path}")
    work = _Work(spark, raw, service, years, key, full=full, skip_failed=skip_failed)
    stats = {f: s for item in inputs for f, s in zip(item.files, item.stats)}
    work.known.update(work.manifest.input_schemas(stats))
    left_out = work.replace(inputs, rows, lambda item: digest(*zip(item.files, item.stats)))
    if mirror:
        work.empty_others({key(item) for item in inputs})
    return left_out


def _side_by_side(work: Callable[[str], list[Input]], services: Iterable[str]) -> list[str]:
    """Work on all services at the same time, each in a folder of its own."""
    services = list(services)
    with ThreadPoolExecutor(max(len(services), 1)) as pool:
        return [item.path for left_out in pool.map(work, services) for item in left_out]


def _folder_key(folder: Input) -> Key:
    """Year and source of a folder of a layer, as Spark reads them off its path."""
    year, source = folder.path.split("/")[-2:]
    return unquote(year.split("=", 1)[1]), unquote(source.split("=", 1)[1])


class _Work:
    """Keeping the source folders of one service of a layer in step with their inputs."""

    def __init__(
        self,
        spark: SparkSession,
        layer: str,
        service: str,
        years: Sequence[int] | None,
        key: Callable[[Input], Key] = _folder_key,
        *,
        base: str | None = None,
        full: bool = False,
        skip_failed: bool = False,
        after: Callable[[Scan], None] | None = None,
    ):
        self.spark, self.layer, self.service, self.years = spark, layer, service, years
        self.key, self.base, self.full, self.skip_failed = key, base, full, skip_failed
        #: Called for each scan whose rows are stored.
        self.after = after or (lambda scan: None)
        self.target = f"{layer}/service={service}"
        self.manifest: Manifest = read_manifest(spark, layer, service)
        #: Schemas of input files; what a scan finds in footers is added.
        self.known: dict[str, str | Exception] = {}
        self.earlier = self._folders()

    def _folders(self) -> dict[Key, Input]:
        found = layer_inputs(self.spark, self.layer, self.service, self.years)
        return {_folder_key(f): f for f in found}

    def replace(
        self,
        inputs: Sequence[Input],
        rows: Callable[[Scan], DataFrame],
        version: Callable[[Input], str],
    ) -> list[Input]:
        """Replace the source folders by the rows of their inputs, where these changed.

        Inputs of one schema are written together. Of those whose part files differ, one
        schema replaces the folder and the others are appended, so that each file keeps
        its own columns. Returns the inputs that were left out; their folders stay as they
        were.
        """
        changed = [item for item in inputs if self.full or not self._holds(item, version(item))]
        if len(changed) < len(inputs):
            unchanged = len(inputs) - len(changed)
            log.info("%d of %d sources of %s unchanged", unchanged, len(inputs), self.target)
        if not changed:
            return []
        schemas: dict[Input, set[str]] = {}
        left_out = self._write(changed, rows, schemas)
        now = self._folders()
        entries = []
        for item in changed:
            key = self.key(item)
            state = LEFT_OUT if item in left_out else STORED if key in now else EMPTY
            own = schemas.get(item, set())
            # Parts of several schemas are told apart by their footers again.
            schema = next(iter(own)) if len(own) == 1 else None
            held = now[key].files if state == STORED else ()
            stats = item.stats or ((None, None),) * len(item.files)
            made_from = [
                File(f, *s, known if isinstance(known := self.known.get(f), str) else None)
                for f, s in zip(item.files, stats)
            ]
            entries.append(
                Entry(key, version(item), tuple(made_from), tuple(File(f, schema=schema) for f in held), state)
            )
        write_manifest(self.spark, self.layer, self.service, entries)
        return left_out

    def _holds(self, item: Input, version: str) -> bool:
        key = self.key(item)
        files = self.earlier[key].files if key in self.earlier else ()
        return self.manifest.holds(key, version, files)

    def _write(
        self,
        inputs: Sequence[Input],
        rows: Callable[[Scan], DataFrame],
        schemas: dict[Input, set[str]],
    ) -> list[Input]:
        def replace(scan: Scan) -> None:
            out = rows(scan)
            note(scan, out)
            write_layer(out, self.target, partition_by=PARTITIONS)
            self.after(scan)

        def note(scan: Scan, out: DataFrame) -> None:
            for item in scan.inputs:
                schemas.setdefault(item, set()).add(_stored_schema(out))

        found = _scans(self.spark, inputs, self.base, self.skip_failed, self.known)
        steady, drifting, left_out = _by_drift(found)
        done, failed = _each_scan(
            self.spark, steady, replace, base=self.base, skip_failed=self.skip_failed, known=self.known
        )
        self._empty_unreplaced(done)
        left_out += failed
        if self.skip_failed and drifting:
            # All parts are tried before the first of them replaces the earlier rows.
            drifting, failed = _each_scan(
                self.spark,
                drifting,
                lambda scan: _try(rows(scan)),
                base=self.base,
                skip_failed=True,
                known=self.known,
            )
            left_out += failed
        begun: set[Input] = set()
        later = []
        for scan in _scans(self.spark, drifting, self.base, False, self.known).scans:
            again = [item for item in scan.inputs if item in begun]
            fresh = [item for item in scan.inputs if item not in begun]
            if fresh:
                replace(scan.part(fresh))
                begun.update(fresh)
            if again:
                later.append(scan.part(again))
        self._empty_unreplaced(drifting)
        for scan in later:
            out = rows(scan)
            note(scan, out)
            with unsorted_folders(self.spark):
                out.write.partitionBy(*PARTITIONS).mode("append").parquet(self.target)
            self.after(scan)
        return left_out

    def _empty_unreplaced(self, items: Iterable[Input]) -> None:
        # Overwriting partitions leaves alone those without new rows, but their earlier
        # rows are no longer true. They still hold the files they held before the run, as
        # every run names its files anew.
        covered = [k for k in map(self.key, items) if k in self.earlier]
        now = self._folders() if covered else {}
        for k in covered:
            if k in now and now[k].files == self.earlier[k].files:
                self._empty(self.earlier[k])

    def _empty(self, folder: Input) -> None:
        log.warning("no rows any more in %s", folder.path)
        schema = self.spark.read.parquet(literal(folder.path)).schema
        empty = self.spark.createDataFrame([], schema)
        empty.write.mode("overwrite").parquet(folder.path)

    def empty_others(self, keys: set[Key]) -> None:
        """Empty the stored sources that are none of ``keys``."""
        withdrawn = digest("withdrawn")
        others = {k: f for k, f in self.earlier.items() if k not in keys}
        gone = [k for k, f in others.items() if not self.manifest.holds(k, withdrawn, f.files)]
        for k in gone:
            self._empty(self.earlier[k])
        now = self._folders() if gone else {}
        entries = [Entry(k, withdrawn, (), tuple(map(File, now[k].files)), STORED) for k in gone]
        write_manifest(self.spark, self.layer, self.service, entries)


def _stored_schema(out: DataFrame) -> str:
    """The schema that files of a partitioned layer get, as their footers will say it."""
    kept = [StructField(f.name, f.dataType) for f in out.schema.fields if f.name not in PARTITIONS]
    return StructType(kept).json()


def _try(df: DataFrame) -> None:
    """Compute all rows and keep none."""
    df.write.format("noop").mode("overwrite").save()


def _by_drift(found: Scans) -> tuple[list[Input], list[Input], list[Input]]:
    """Inputs of one schema, those whose parts differ, and those that are unreadable."""
    times = Counter(item for scan in found.scans for item in scan.inputs)
    steady = [item for item, n in times.items() if n == 1]
    drifting = [item for item, n in times.items() if n > 1]
    return steady, drifting, list(found.left_out)


def _each_scan(
    spark: SparkSession,
    inputs: Sequence[Input],
    run: Callable[[Scan], None],
    *,
    base: str | None = None,
    skip_failed: bool = False,
    known: dict[str, str | Exception] | None = None,
) -> tuple[list[Input], list[Input]]:
    """Run a job per distinct schema; where one fails, isolate the inputs that cause it.

    With ``skip_failed`` the inputs of a job that failed on their data are halved and run
    again until those that fail by themselves are found; these are logged and left out as
    a whole. Other failures are raised. Returns the inputs that were run and those that
    were left out.
    """
    found = _scans(spark, inputs, base, skip_failed, known)
    done: list[Input] = []
    left_out = list(found.left_out)
    for scan in found.scans:
        try:
            run(scan)
            done += scan.inputs
        except Exception as error:
            if not (skip_failed and is_input_fault(error)):
                raise
            if len(scan.inputs) == 1:
                log.error("left out %s: %s", scan.inputs[0].path, error)
                left_out += scan.inputs
                continue
            log.warning("halving %d inputs after: %s", len(scan.inputs), error)
            middle = len(scan.inputs) // 2
            for half in (scan.inputs[:middle], scan.inputs[middle:]):
                more, failed = _each_scan(
                    spark, half, run, base=base, skip_failed=True, known=known
                )
                done += more
                left_out += failed
    bad = set(left_out)
    return [item for item in dict.fromkeys(done) if item not in bad], list(dict.fromkeys(left_out))


def _scans(
    spark: SparkSession,
    inputs: Iterable[Input],
    base: str | None,
    skip_unreadable: bool,
    known: dict[str, str | Exception] | None = None,
) -> Scans:
    types = _PARTITION_TYPES if base else ""
    return scan_by_schema(
        spark, inputs, base=base, partitions=types, skip_unreadable=skip_unreadable, known=known
    )


def _any_of(years: Iterable[int] | None) -> str:
    """Glob for the given years, or for any."""
    return "*" if years is None else "{" + ",".join(str(y) for y in years) + "}"


def layer_inputs(
    spark: SparkSession, root: str, service: str, years: Iterable[int] | None = None
) -> list[Input]:
    """The ``source`` folders of one service in a layer, of all or of the given years."""
    pattern = f"{root}/service={service}/batch_year={_any_of(years)}/*/*.parquet"
    return list_inputs(spark, pattern, PARENT_FOLDER)


def clean_layer(
    spark: SparkSession,
    raw: str,
    clean: str,
    zones: DataFrame,
    *,
    years: Iterable[int] | None = None,
    skip_failed: bool = False,
    full: bool = False,
    metrics: str | None = None,
) -> list[str]:
    """Clean and enrich every source of the raw layer; returns the sources left out.

    A job per service and distinct schema covers all months at once. With a broadcast
    lookup it is a single pass from scan to write. Sources that were cleaned from the same
    raw files with the same lookup stay as they are, unless ``full`` asks for all.
    ``metrics`` is a folder that keeps the counts of each job, told apart by ``run_at``:
    rows read, dropped by rule and written, gathered in the job itself.
    """
    years = None if years is None else list(years)
    counted = zones.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(row_bytes(zones)).alias("bytes"),
        F.bit_xor(F.xxhash64(*zones.columns)).alias("mark"),
    ).first()
    small = counted.rows <= BROADCAST_ROWS and (counted.bytes or 0) <= BROADCAST_BYTES
    run_at = datetime.now(timezone.utc)
    stored: list[tuple] = []

    def work(service: str) -> list[Input]:
        watched: dict[Scan, CleaningCounts] = {}

        def rows(scan: Scan) -> DataFrame:
            watch = None
            if metrics:
                watched[scan] = CleaningCounts()
                watch = watched[scan].watch
            return clean_trips(scan.df, zones, service, small=small, watch=watch).drop("service")

        def keep(scan: Scan) -> None:
            if metrics:
                counts = watched[scan].counts()
                sources = sorted("/".join(_folder_key(item)) for item in scan.inputs)
                stored.append((run_at, service, sources, *counts.values()))

        return _derive_layer(
            spark,
            raw,
            clean,
            service,
            years,
            rows,
            (tuple(counted), zones.schema.json()),
            full=full,
            skip_failed=skip_failed,
            after=keep,
        )

    left_out = _side_by_side(work, SERVICES)
    if stored:
        spark.createDataFrame(stored, CLEANING_METRICS).coalesce(1).write.mode("append").parquet(metrics)
    return left_out


# One row for each job of cleaning.
CLEANING_METRICS = (
    "run_at timestamp, service string, sources array<string>, rows_read long, "
    "incomplete long, no_zone long, no_id long, rows_written long"
)


def _derive_layer(
    spark: SparkSession,
    source: str,
    target: str,
    service: str,
    years: Sequence[int] | None,
    rows: Callable[[Scan], DataFrame],
    also: object = None,
    *,
    full: bool = False,
    skip_failed: bool = False,
    after: Callable[[Scan], None] | None = None,
) -> list[Input]:
    """Make a service's sources of one layer from those of another, where these changed.

    Files of a layer are never written twice under a name, so the names say what a source
    holds; ``also`` is what else the rows depend on.
    """
    work = _Work(
        spark, target, service, years, base=source, full=full, skip_failed=skip_failed, after=after
    )
    work.known.update(read_manifest(spark, source, service).stored_schemas())
    inputs = layer_inputs(spark, source, service, years)
    return work.replace(inputs, rows, lambda item: digest(item.files, also))


def _write_isolated(
    spark: SparkSession,
    layer: str,
    years: Sequence[int] | None,
    rows: Callable[[Scan, str], DataFrame],
    write: Callable[[list[DataFrame], set[Key]], None],
    *,
    skip_failed: bool = False,
) -> list[str]:
    """Write the sources of all services of a layer in one job.

    ``write`` gets a frame for each scan and the (service, year) pairs of which a source
    was left out. If the job fails on the data of a source, every scan is tried by itself
    to find those sources, and the job runs again without them.
    """
    inputs = {service: layer_inputs(spark, layer, service, years) for service in SERVICES}
    known = _known_schemas(spark, layer)
    left_out: list[tuple[str, Input]] = []

    def frames_of(service: str) -> list[DataFrame]:
        while True:
            bad = {item for s, item in left_out if s == service}
            good = [item for item in inputs[service] if item not in bad]
            found = _scans(spark, good, layer, skip_failed, known)
            absent: list[Input] = list(found.left_out)
            out = []
            for scan in found.scans:
                try:
                    out.append(rows(scan, service))
                except AnalysisException as error:
                    if not (skip_failed and is_input_fault(error)):
                        raise
                    log.error("left out %s: %s", ", ".join(i.path for i in scan.inputs), error)
                    absent += scan.inputs
            left_out.extend((service, item) for item in dict.fromkeys(absent))
            # An input with other parts in the scans that did succeed goes as a whole.
            if len(absent) == len(found.left_out):
                return out

    def run() -> None:
        made = [frame for service in SERVICES for frame in frames_of(service)]
        write(made, {(service, _folder_key(item)[0]) for service, item in left_out})

    try:
        run()
    except Exception as error:
        if not (skip_failed and is_input_fault(error)):
            raise
        log.warning("trying the sources of %s one by one after: %s", layer, error)
        before = len(left_out)
        for service in SERVICES:
            _, failed = _each_scan(
                spark,
                inputs[service],
                lambda scan, service=service: _try(rows(scan, service)),
                base=layer,
                skip_failed=True,
                known=known,
            )
            left_out += [(service, f) for f in failed if (service, f) not in left_out]
        if len(left_out) == before:
            raise
        run()
    return [item.path for _, item in left_out]


def _known_schemas(spark: SparkSession, layer: str) -> dict[str, str | Exception]:
    """Schemas of the files of a layer, as far as its manifests have them."""
    known: dict[str, str | Exception] = {}
    for service in SERVICES:
        known.update(read_manifest(spark, layer, service).stored_schemas())
    return known


def convert_layer(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fmt: str = "delta",
    years: Iterable[int] | None = None,
    options: Mapping[str, str] | None = None,
    skip_unreadable: bool = False,
) -> list[str]:
    """Rewrite a layer in another format as one table partitioned by service and year.

    Returns the sources left out. A year of a service that is there already and of which a
    source was left out stays as it is; one without rows is emptied (not in a Delta table,
    from which its own DELETE takes them).
    """
    years = None if years is None else list(years)

    def write(frames: list[DataFrame], kept: set[Key]) -> None:
        if not frames:
            log.warning("nothing to convert below %s", source)
            return
        earlier = {_folder_key(folder): folder for folder in _partitions(spark, target)}
        together = _without(union_drifted(frames), "service", kept & earlier.keys())
        write_layer(
            together,
            target,
            partition_by=("service", "batch_year"),
            fmt=fmt,
            options=options,
        )
        if fmt == "delta":
            return  # its log, not its folders, says which rows there are
        now = {_folder_key(folder): folder for folder in _partitions(spark, target)}
        for pair, folder in earlier.items():
            asked = years is None or pair[1] in map(str, years)
            if asked and pair not in kept and now[pair].files == folder.files:
                log.warning("no rows any more in %s", folder.path)
                schema = spark.read.format(fmt).load(folder.path).schema
                empty = spark.createDataFrame([], schema)
                empty.write.format(fmt).mode("overwrite").save(folder.path)

    return _write_isolated(
        spark, source, years, lambda scan, _: scan.df, write, skip_failed=skip_unreadable
    )


# Sources that are converted at the same time.
CONVERTERS = 8


def convert_sources(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    fmt: str = "delta",
    years: Iterable[int] | None = None,
    options: Mapping[str, str] | None = None,
    skip_failed: bool = False,
    full: bool = False,
) -> list[str]:
    """Rewrite every source of a layer as a table of its own, under its own schema.

    Months whose columns differ need no common type then. A table lies where its source
    does below ``target``; sources that were converted from the same files stay as they
    are. Where the parts of one source differ, its table has a column for each. Returns
    the sources left out.
    """
    years = None if years is None else list(years)

    def work(service: str) -> list[Input]:
        done = read_manifest(spark, target, service)
        known: dict[str, str | Exception] = dict(read_manifest(spark, source, service).stored_schemas())
        inputs = layer_inputs(spark, source, service, years)
        versions = {item: digest(item.files, fmt) for item in inputs}
        todo = [i for i in inputs if full or not done.holds(_folder_key(i), versions[i], ())]
        found = _scans(spark, todo, None, skip_failed, known)
        parts: dict[Input, list[DataFrame]] = {}
        for scan in found.scans:
            for item in scan.inputs:
                parts.setdefault(item, []).append(scan.part([item]).df)

        def convert(item: Input) -> Entry | None:
            if item in found.left_out:
                return None
            folder = "/".join([target, *item.path.split("/")[-3:]])
            try:
                table = parts[item][0] if len(parts[item]) == 1 else union_drifted(parts[item])
                table.write.format(fmt).mode("overwrite").options(**(options or {})).save(folder)
            except Exception as error:
                if not (skip_failed and is_input_fault(error)):
                    raise
                log.error("left out %s: %s", item.path, error)
                return None
            return Entry(_folder_key(item), versions[item], tuple(map(File, item.files)))

        with ThreadPoolExecutor(CONVERTERS) as pool:
            made = dict(zip(todo, pool.map(convert, todo)))
        write_manifest(spark, target, service, [entry for entry in made.values() if entry])
        return [item for item, entry in made.items() if entry is None]

    return _side_by_side(work, SERVICES)


def _partitions(spark: SparkSession, table: str) -> list[Input]:
    """The folders of a stored table of two partition levels, of any format."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .load(f"{table}/*=*/*=*")
            .inputFiles()
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    folders: dict[str, list[str]] = {}
    for file in sorted(unquote(f) for f in files):
        folders.setdefault(file.rsplit("/", 1)[0], []).append(file)
    return [Input(path, tuple(names)) for path, names in folders.items()]


def _without(df: DataFrame, service: str, pairs: Iterable[tuple[object, str]]) -> DataFrame:
    """Rows of other years and services than the given pairs."""
    for value, year in sorted(pairs):
        log.warning("%s of %s stays as it is, as a source was left out", year, value)
        df = df.where(~((F.col(service) == value) & (F.col("batch_year") == int(year))))
    return df


def _staging_source(scan: Scan, service: str) -> DataFrame:
    tagged = scan.df.withColumn("service_type", F.lit(SERVICES[service]))
    return staging_input(tagged, "service_type", "batch_year")


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def read_clean(
    spark: SparkSession, clean: str, years: Iterable[int] | None = None
) -> DataFrame | None:
    """The clean trips of both services, as far as staging needs them; None if none.

    A source that lacks a column staging needs is an error.
    """
    years = None if years is None else list(years)
    known = _known_schemas(spark, clean)
    frames = [
        _staging_source(scan, service)
        for service in SERVICES
        for scan in _scans(spark, layer_inputs(spark, clean, service, years), clean, False, known).scans
    ]
    return _stack(frames) if frames else None


@dataclass(frozen=True)
class Warehouse:
    """Where the stored tables live. Give ``root`` unless the catalog has a shared folder."""

    staging: str = "staging"
    production: str = "production"
    root: str | None = None

    def folder(self, schema: str) -> str | None:
        return f"{self.root}/{schema}" if self.root else None

    @property
    def staging_table(self) -> str:
        return f"{self.staging}.trips"


def create_warehouse(spark: SparkSession, warehouse: Warehouse) -> None:
    """Create both schemas and the staging table where they are missing."""
    for schema in (warehouse.staging, warehouse.production):
        create_schema(spark, schema, location=warehouse.folder(schema))
    _declare_staging(spark, warehouse, replace=False)


def reset_warehouse(spark: SparkSession, warehouse: Warehouse, *, cascade: bool = False) -> None:
    """Drop and create both schemas, and create the empty staging table.

    The stored rows of the star, which the production schema shows, go with it.
    """
    for schema in (warehouse.staging, warehouse.production, store_schema(warehouse.production)):
        reset_schema(spark, schema, location=warehouse.folder(schema), cascade=cascade)
    _declare_staging(spark, warehouse, replace=True)


def _declare_staging(spark: SparkSession, warehouse: Warehouse, *, replace: bool) -> None:
    create_table(
        spark,
        warehouse.staging_table,
        StructType([*STAGING.fields, StructField("batch_year", IntegerType())]),
        partition_by=("batch_year", "service_type"),
        replace=replace,
    )


def _staging_of(frames: Sequence[DataFrame], clean: str) -> DataFrame | None:
    """The staging rows of clean trips with their ``batch_year``; None if there are none.

    One shuffle does the grouping of both services and all years.
    """
    if not frames:
        log.warning("no clean trips below %s", clean)
        return None
    return _stack(frames).transform(staging_rows, "batch_year")


def load_staging(
    spark: SparkSession,
    clean: str,
    warehouse: Warehouse,
    *,
    years: Iterable[int] | None = None,
    append: bool = False,
    skip_failed: bool = False,
    left_out: list[str] | None = None,
    compact: bool = False,
) -> DataFrame:
    """Replace the years the clean trips belong to in the staging table, or append to it.

    The years are those of the delivery, not of the pickup: a stray trip dated years
    back must not replace that year's rows. A year of a service that was asked for and
    has no rows any more leaves the table. With ``skip_failed``, sources that cannot be
    read or staged are left out and added to ``left_out``; a year of a service that is
    staged already and of which a source was left out stays as it is. ``compact`` shuffles
    the grouped rows once more by year and service (splitting large ones), so that not
    every task writes a file for each of them.
    """
    table = warehouse.staging_table
    years = None if years is None else list(years)

    def write(frames: list[DataFrame], kept: set[Key]) -> None:
        pairs = {(str(SERVICES[service]), year) for service, year in kept}
        staged = _staged(spark, table, years)
        if kept and not append:
            frames = [_without(f, "service_type", pairs & staged.keys()) for f in frames]
        rows = _staging_of(frames, clean)
        if rows is None:
            return
        columns = spark.table(table).columns
        if compact:
            rows = rows.hint("rebalance", F.col("batch_year"), F.col("service_type"))
        with unsorted_folders(spark):
            rows.select(*columns).write.insertInto(table, overwrite=not append)
        if append:
            return
        _drop_unreplaced(spark, table, years, staged, staged.keys() - pairs)

    failed = _write_isolated(spark, clean, years, _staging_source, write, skip_failed=skip_failed)
    if left_out is not None:
        left_out += failed
    return read_staging(spark, table)


Pair = tuple[str, str]  # service and year of delivery

# What is stored of a source between cleaning and staging.
_SUMS = StructType([f for f in STAGING.fields if f.name not in CALENDAR])
# The sources of a staged year and service, as one entry of a manifest.
_ALL = "all"


def partial_layer(
    spark: SparkSession,
    clean: str,
    partials: str,
    *,
    years: Iterable[int] | None = None,
    skip_failed: bool = False,
    full: bool = False,
) -> list[str]:
    """Store the sums of each clean source by itself; returns the sources left out.

    A source that did not change keeps its sums, so a month delivered anew is the only one
    that is grouped again.
    """
    years = None if years is None else list(years)

    def work(service: str) -> list[Input]:
        def rows(scan: Scan) -> DataFrame:
            tagged = scan.df.withColumn("service_type", F.lit(SERVICES[service]))
            keys = ("service_type", *PARTITIONS)
            return conform(
                partial_sums(staging_input(tagged, *keys), *keys),
                StructType([*_SUMS.fields, *StructType.fromDDL("batch_year int, source string").fields]),
            )

        return _derive_layer(
            spark, clean, partials, service, years, rows, _SUMS.json(), full=full, skip_failed=skip_failed
        )

    return _side_by_side(work, SERVICES)


def merge_staging(
    spark: SparkSession,
    partials: str,
    warehouse: Warehouse,
    *,
    years: Iterable[int] | None = None,
    full: bool = False,
) -> list[Pair]:
    """Combine the stored sums into the staging table; returns the pairs that were replaced.

    A year of a service is combined anew if one of its sources changed or its staged rows
    are not those of the last run. One that has no rows any more leaves the table.
    """
    table = warehouse.staging_table
    years = None if years is None else list(years)
    log_folder = f"{partials}/_staged"
    staged = _staged(spark, table, years)
    found: dict[Pair, list[Input]] = {}
    for service in SERVICES:
        for folder in layer_inputs(spark, partials, service, years):
            found.setdefault((service, _folder_key(folder)[0]), []).append(folder)
    logs = {service: read_manifest(spark, log_folder, service) for service in SERVICES}
    versions = {pair: digest(*[f.files for f in folders]) for pair, folders in found.items()}

    def files(pair: Pair, now: Mapping[tuple[str, str], Input]) -> tuple[str, ...]:
        held = now.get((str(SERVICES[pair[0]]), pair[1]))
        return held.files if held else ()

    changed = [
        (service, year)
        for (service, year), version in versions.items()
        if full or not logs[service].holds((year, _ALL), version, files((service, year), staged))
    ]
    if not changed:
        log.info("staging is up to date")
        return []
    types = StructType([*_SUMS.fields, *StructType.fromDDL(_PARTITION_TYPES).fields])
    paths = [literal(folder.path) for pair in changed for folder in found[pair]]
    sums = spark.read.schema(types).option("basePath", partials).parquet(*paths).drop("service", "source")
    rows = staging_rows(sums, "batch_year")
    with unsorted_folders(spark):
        rows.select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    _drop_unreplaced(spark, table, years, staged, {(str(SERVICES[s]), y) for s, y in changed})
    now = _staged(spark, table, years)
    for service in SERVICES:
        entries = [
            Entry((year, _ALL), versions[s, year], (), tuple(File(f) for f in files((s, year), now)))
            for s, year in changed
            if s == service
        ]
        write_manifest(spark, log_folder, service, entries)
    return changed


def _drop_unreplaced(
    spark: SparkSession,
    table: str,
    years: Sequence[int] | None,
    staged: Mapping[tuple[str, str], Input],
    pairs: Iterable[tuple[str, str]],
) -> None:
    """Drop those partitions of ``pairs`` that hold the same files as before the write."""
    present = _staged(spark, table, years)
    for pair in pairs:
        if pair in staged and pair in present and present[pair].files == staged[pair].files:
            partition = ", ".join(present[pair].path.split("/")[-2:])
            log.warning("no rows any more in %s (%s)", table, partition)
            spark.sql(f"ALTER TABLE {table} DROP PARTITION ({partition})")


def _staged(
    spark: SparkSession, table: str, years: Sequence[int] | None
) -> dict[tuple[str, str], Input]:
    """The folder of each stored service and year of the staging table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    location = described.where("col_name = 'Location'").first().data_type
    pattern = f"{location}/batch_year={_any_of(years)}/*/*.parquet"
    folders = list_inputs(spark, pattern, PARENT_FOLDER)
    return {tuple(reversed(_folder_key(folder))): folder for folder in folders}


def load_staging_jdbc(
    spark: SparkSession,
    clean: str,
    url: str,
    table: str,
    properties: Mapping[str, str],
    *,
    years: Iterable[int] | None = None,
    mode: str = "append",
) -> None:
    """Append the staging rows to a table of a relational warehouse instead.

    There is no leaving out here: an append that ran in part cannot be repeated, and rows
    of a year that lacks a source could not be told from complete ones.
    """
    trips = read_clean(spark, clean, years)
    rows = _staging_of([trips] if trips is not None else [], clean)
    if rows is not None:
        append_jdbc(rows.drop("batch_year"), url, table, properties, mode=mode)


def validate_staging(
    spark: SparkSession,
    warehouse: Warehouse,
    suite: Iterable[Expectation] = STAGING_SUITE,
    *,
    results: str | None = None,
) -> DataFrame:
    """Hold the stored staging table to a suite; returns the report of this run.

    ``results`` is a folder that keeps the reports of all runs, told apart by ``run_at``.
    """
    report = validate(read_staging(spark, warehouse.staging_table), suite)
    if results:
        run_at = F.lit(datetime.now(timezone.utc))
        kept = report.withColumn("run_at", run_at)
        kept.write.mode("append").parquet(results)
        kept = spark.read.schema(kept.schema).parquet(results)
        report = kept.where(F.col("run_at") == run_at).drop("run_at")
    return report


def validate_changed(
    spark: SparkSession,
    warehouse: Warehouse,
    counts: str,
    suite: Iterable[Expectation] = STAGING_SUITE,
) -> DataFrame:
    """Hold staging to a suite, reading only what changed since the last run; the report.

    ``counts`` is a folder that keeps the suite's counts of each staged year and service,
    marked with the files they were counted in and the suite. Partitions whose files are
    the same are not read again.
    """
    suite = tuple(suite)
    table = warehouse.staging_table
    versions = {
        part_name(year, service): digest(part_name(year, service), folder.files, suite_to_json(suite))
        for (service, year), folder in _staged(spark, table, None).items()
    }
    types = "version string, position int, element_count long, missing_count long, unexpected_count long"

    def kept() -> DataFrame:
        return spark.read.schema(types).parquet(counts)

    def known() -> set[str]:
        try:
            return {r.version for r in kept().select("version").distinct().collect()}
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return set()

    had = known()
    missing = {part: version for part, version in versions.items() if version not in had}
    log.info("checking %d of %d parts of %s", len(missing), len(versions), table)
    if missing or not had:
        part = F.concat_ws("/", F.col("batch_year").cast("string"), F.col("service_type").cast("string"))
        marks = F.create_map(*[F.lit(x) for pair in sorted(missing.items()) for x in pair]).cast("map<string, string>")
        rows = spark.table(table).where(part.isin(sorted(missing)) if missing else F.lit(False))
        fresh = check_counts(rows, suite, "batch_year", "service_type")
        fresh = fresh.withColumn("version", F.try_element_at(marks, part))
        names = [f.name for f in StructType.fromDDL(types).fields]
        fresh.select(*names).write.mode("append").parquet(counts)
    # A run that stopped can have left the same counts before.
    mine = kept().where(F.col("version").isin(sorted(versions.values()))).distinct()
    return combined_report(mine, suite)


def load_star(
    spark: SparkSession, warehouse: Warehouse, *, full: bool = False, clustered: bool = False
) -> dict[str, DataFrame]:
    """Build the six dimensions and then the fact as stored tables, and switch to them.

    Readers see the star of the run before until all seven tables are finished, and a
    build that fails leaves it as it is. The fact is stored by year of delivery and
    service; parts whose staging files are those they were built from stay valid as
    stored, unless ``full`` asks for all. That holds as long as each location has one
    place; where one has several, trips of any part can repeat, so all parts are built.
    ``clustered`` lays the fact out by time and place, see ``store_rows``.
    """
    production = warehouse.production
    create_store(spark, production, warehouse.folder(store_schema(production)))
    before, build = current(spark, production), new_build()
    made_from = {
        part_name(year, service): digest(folder.files)
        for (service, year), folder in _staged(spark, warehouse.staging_table, None).items()
    }
    kept: dict[str, str] = {}
    if before is not None and not full:
        kept = {p: b for p, b in before.fact.items() if before.made_from.get(p) == made_from.get(p)}
        if kept.keys() == made_from.keys() == before.fact.keys():
            log.info("the star is up to date")
            return read_star(spark, production)
    table = spark.table(warehouse.staging_table)

    def facts(dims: Mapping[str, DataFrame]) -> DataFrame:
        rows = table
        if kept and not (_one_place(dims) and _one_place(read_version(spark, production, before))):
            kept.clear()
        if kept:
            log.info("%d of %d parts of the fact are built", len(made_from) - len(kept), len(made_from))
            part = F.concat_ws("/", F.col("batch_year").cast("string"), F.col("service_type").cast("string"))
            rows = table.where(~part.isin(sorted(kept)))
        return fact_trip(rows, dims, "batch_year")

    staging = read_staging(spark, warehouse.staging_table)
    # Dimensions come first, so a location in two places is known before the fact is built.

    def store(name: str, df: DataFrame) -> DataFrame:
        return store_rows(df, production, name, build, clustered=clustered)

    build_star(staging, store, facts=facts)
    switch(spark, production, Current(build, {part: kept.get(part, build) for part in made_from}, made_from))
    return read_star(spark, production)


def _one_place(star: Mapping[str, DataFrame]) -> bool:
    """Whether no location id has several rows, so that no trip is repeated."""
    return all(
        star[name].groupBy(NATURAL_KEYS[name]).count().where("count > 1").isEmpty()
        for name in ("dimPickupLocation", "dimDropoffLocation")
    )


def run_all(
    spark: SparkSession,
    base: str,
    lake: str,
    zones: DataFrame,
    warehouse: Warehouse,
    years: Sequence[int],
    *,
    services: Sequence[str] = tuple(SERVICES),
    layout: str = LAYOUT,
    reset: bool = False,
    skip_failed: bool = False,
    left_out: list[str] | None = None,
) -> dict[str, DataFrame]:
    """Every stage in order; returns the star, the staging report and the star tests.

    Years loaded before stay in the warehouse unless ``reset`` drops both schemas. What
    ``skip_failed`` leaves out in any stage is added to ``left_out``.
    """
    left_out = [] if left_out is None else left_out
    left_out += load_raw(
        spark,
        base,
        f"{lake}/raw",
        years,
        services=services,
        layout=layout,
        skip_failed=skip_failed,
    )
    left_out += clean_layer(
        spark, f"{lake}/raw", f"{lake}/clean", zones, years=years, skip_failed=skip_failed
    )
    if reset:
        reset_warehouse(spark, warehouse, cascade=True)
    else:
        create_warehouse(spark, warehouse)
    load_staging(
        spark,
        f"{lake}/clean",
        warehouse,
        years=years,
        skip_failed=skip_failed,
        left_out=left_out,
    )
    report = validate_staging(spark, warehouse)
    star = load_star(spark, warehouse)
    return {**star, "staging_report": report, "star_report": star_tests(star)}


def run_changed(
    spark: SparkSession,
    base: str,
    lake: str,
    zones: DataFrame,
    warehouse: Warehouse,
    years: Sequence[int],
    *,
    services: Sequence[str] = tuple(SERVICES),
    layout: str = LAYOUT,
    mirror: bool = False,
    skip_failed: bool = False,
    left_out: list[str] | None = None,
    clustered: bool = False,
) -> dict[str, DataFrame]:
    """Bring every layer, the staging table and the star up to date; returns the star.

    Each step compares what it has with what it was made from and works on the sources
    that changed: a month delivered anew is loaded, cleaned and grouped by itself, its year
    and service are combined from stored sums, and only their part of the fact is built.
    The result is that of ``run_all`` over the same delivery. With ``mirror``, sources of
    the given years that are no longer delivered leave it.
    """
    left_out = [] if left_out is None else left_out
    raw, clean, partials = (f"{lake}/{layer}" for layer in ("raw", "clean", "sums"))
    years = list(years)
    left_out += load_raw(
        spark, base, raw, years, services=services, layout=layout, mirror=mirror, skip_failed=skip_failed
    )
    left_out += clean_layer(spark, raw, clean, zones, years=years, skip_failed=skip_failed)
    left_out += partial_layer(spark, clean, partials, years=years, skip_failed=skip_failed)
    create_warehouse(spark, warehouse)
    merge_staging(spark, partials, warehouse, years=years)
    return load_star(spark, warehouse, clustered=clustered)
