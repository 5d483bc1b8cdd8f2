"""Finding and scanning the monthly Parquet inputs of a layer."""

from __future__ import annotations

import hashlib
import json
import logging
import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pandas as pd
from pyarrow.fs import FileSystem, S3FileSystem
from pyarrow.parquet import ParquetFile
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegralType,
    LongType,
    NullType,
    NumericType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

log = logging.getLogger(__name__)


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    """One scan over any number of files or folders."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(*paths)


def read_tree(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """Every ``*.parquet`` file below ``root``, at any depth; other files are left out."""
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return (reader.schema(schema) if schema is not None else reader).parquet(root)


# Up to the first part that ends in .parquet: a file, or the folder around its parts.
WHOLE_INPUT = r"^(.*?\.parquet)(/.*)?$"
PARENT_FOLDER = r"^(.*)/[^/]+$"

# Threads that ask Spark for one schema each, and files whose footers a task reads.
SCHEMA_READERS = 16
FOOTERS_PER_TASK = 64


@dataclass(frozen=True)
class Input:
    """A monthly input (a file or a folder of part files) and its files, sorted."""

    path: str
    files: tuple[str, ...]
    #: Size and modification time (ms) of each file, if they were asked for.
    stats: tuple[tuple[int, int], ...] = ()

    @property
    def sample(self) -> str:
        return self.files[0]


def list_inputs(
    spark: SparkSession, pattern: str | list[str], unit: str = WHOLE_INPUT, *, stats: bool = False
) -> list[Input]:
    """Parquet inputs matched by a glob or several; ``unit`` tells a file's input from its path.

    Spark lists the files, at any depth; no job reads them. Only names come to the driver,
    with ``stats`` also sizes and times, which one job gathers without opening a file.
    """
    try:
        listing = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.parquet")
            .load(pattern)
        )
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    if stats:
        found = listing.select("path", "length", F.unix_millis("modificationTime").alias("at"))
        marks = {r.path: (r.length, r.at) for r in found.collect()}
    else:
        marks = dict.fromkeys(unquote(f) for f in listing.inputFiles())
    inputs: dict[str, list[str]] = {}
    for file in sorted(marks):
        inputs.setdefault(re.match(unit, file).group(1), []).append(file)
    return [
        Input(path, tuple(files), tuple(marks[f] for f in files) if stats else ())
        for path, files in sorted(inputs.items())
    ]


@dataclass(frozen=True)
class Scan:
    """Inputs whose files, or some of whose files, share one schema, as one frame."""

    df: DataFrame
    inputs: tuple[Input, ...]
    #: The same for some of the inputs.
    part: Callable[[Iterable[Input]], Scan]


@dataclass(frozen=True)
class Scans:
    """The scans of some inputs, and the inputs that were left out as unreadable."""

    scans: tuple[Scan, ...]
    left_out: tuple[Input, ...] = ()


def s3_settings(spark: SparkSession) -> dict[str, object]:
    """What the session says about its S3 store, as arguments of pyarrow's S3 file system."""

    def setting(name: str) -> str | None:
        return spark.conf.get(f"spark.hadoop.fs.s3a.{name}", None)

    found: dict[str, object] = {}
    for name, ours in (("access.key", "access_key"), ("secret.key", "secret_key"), ("endpoint.region", "region")):
        if setting(name):
            found[ours] = setting(name)
    endpoint = setting("endpoint")
    if endpoint:
        scheme, mark, host = endpoint.rpartition("://")
        secure = (setting("connection.ssl.enabled") or "true").lower() != "false"
        found["endpoint_override"] = host.rstrip("/")
        found["scheme"] = scheme if mark else "https" if secure else "http"
    return found


def _open_store(path: str, s3: Mapping[str, object]) -> tuple[FileSystem, str]:
    """The store of a URI and the name in it; ``s3a`` is Spark's name for S3."""
    scheme, _, rest = path.partition("://")
    if scheme in ("s3a", "s3n"):
        return S3FileSystem(**s3), unquote(rest)
    return FileSystem.from_uri(path)


def _footer_marks(s3: Mapping[str, object], open_store=_open_store) -> Callable:
    """A digest of the schema in each file's footer; null where it cannot be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            marks = []
            for path in batch["path"]:
                try:
                    system, name = open_store(path, s3)
                    with system.open_input_file(name) as file:
                        footer = ParquetFile(file)
                        own = (footer.metadata.metadata or {}).get(SPARK_SCHEMA, b"")
                        # The first line of the text is the object's address.
                        text = str(footer.schema).split("\n", 1)[-1]
                    marks.append(hashlib.sha256(own + text.encode()).hexdigest())
                except Exception:  # Spark tries these again, and says why it cannot.
                    marks.append(None)
            yield pd.DataFrame({"path": batch["path"], "mark": marks})

    return run


# Fixed value: the footer entry under which Spark keeps its own form of the schema.
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def _schemas_of_files(spark: SparkSession, files: Sequence[str]) -> dict[str, str | Exception]:
    """Each file's schema as JSON, or the error that reading it gives.

    Footers are read in tasks, and Spark is asked for the schema of one file for each
    distinct footer. Tasks read ``s3a`` with the session's settings of that store. Files in
    a store that their reader does not know are asked for one by one, and so are a few
    files, for which Python workers would start in vain.
    """
    if not files:
        return {}

    def schema_of(file: str) -> str | Exception:
        try:
            return spark.read.parquet(literal(file)).schema.json()
        except Exception as error:
            return error

    if len(files) <= FOOTERS_PER_TASK:
        with ThreadPoolExecutor(SCHEMA_READERS) as pool:
            return dict(zip(files, pool.map(schema_of, files)))

    names = spark.createDataFrame(
        pd.DataFrame({"path": [as_uri(f) for f in files]}), "path string"
    )
    read = names.repartition(-(-len(files) // FOOTERS_PER_TASK)).mapInPandas(
        _footer_marks(s3_settings(spark)), "path string, mark string"
    )
    marks = {unquote(r.path): r.mark for r in read.collect()}
    first: dict[str, str] = {}
    for file in files:
        first.setdefault(marks[unquote(as_uri(file))] or file, file)
    with ThreadPoolExecutor(SCHEMA_READERS) as pool:
        schemas = dict(zip(first, pool.map(schema_of, first.values())))
    return {file: schemas[marks[unquote(as_uri(file))] or file] for file in files}


def as_uri(path: str) -> str:
    """A path as Spark lists it, with what a URI cannot hold escaped."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        return quote(path)
    return f"{scheme}:/{quote(rest)}"


def literal(path: str) -> str:
    """A path in which no sign is taken for a glob."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def scan_by_schema(
    spark: SparkSession,
    inputs: Iterable[Input],
    *,
    base: str | None = None,
    partitions: str = "",
    skip_unreadable: bool = False,
    known: dict[str, str | Exception] | None = None,
) -> Scans:
    """One scan per distinct schema among the files of ``inputs``.

    Inputs that are folders of a layer below ``base`` also get its ``partitions``, given
    as column definitions. Footers are read of those files only that ``known`` does not
    have; what they say is added to it.

    Monthly inputs, and the part files of one input, differ in columns and types. Reading
    them as one would either fail or fill absent columns with nulls, for which cleaning
    then drops their rows. An input whose parts differ takes part in several scans. One
    with a file that cannot be read is an error, or is logged and left out as a whole.
    """
    inputs = list(inputs)
    schemas = {} if known is None else known
    unknown = [f for item in inputs for f in item.files if f not in schemas]
    schemas.update(_schemas_of_files(spark, unknown))
    groups: dict[str, dict[Input, list[str]]] = {}
    left_out = []
    for item in inputs:
        errors = [schemas[f] for f in item.files if isinstance(schemas[f], Exception)]
        if errors and not (skip_unreadable and is_input_fault(errors[0])):
            raise errors[0]
        if errors:
            log.error("left out %s: %s", item.path, errors[0])
            left_out.append(item)
            continue
        for file in item.files:
            groups.setdefault(schemas[file], {}).setdefault(item, []).append(file)
    scans = []
    for schema, items in groups.items():
        columns = StructType.fromJson(json.loads(schema)).fields
        known = StructType([*columns, *StructType.fromDDL(partitions).fields])
        scans.append(_scan(spark, base, known, items))
    return Scans(tuple(scans), tuple(left_out))


def _scan(
    spark: SparkSession, base: str | None, schema: StructType, items: Mapping[Input, list[str]]
) -> Scan:
    paths = []
    for item, files in items.items():
        paths += [item.path] if len(files) == len(item.files) else files
    reader = spark.read.option("basePath", base) if base else spark.read
    return Scan(
        reader.schema(schema).parquet(*map(literal, paths)),
        tuple(items),
        lambda some: _scan(spark, base, schema, {item: items[item] for item in some}),
    )


# Conditions under which Spark reports a file it cannot read, or a column that is absent.
INPUT_FAULTS = (
    "FAILED_READ_FILE",
    "CANNOT_READ_FILE_FOOTER",
    "PARQUET_COLUMN_DATA_TYPE_MISMATCH",
    "UNABLE_TO_INFER_SCHEMA",
    "UNRESOLVED_COLUMN",
)


def is_input_fault(error: Exception) -> bool:
    """Whether an error comes from an input's own data rather than from the cluster.

    A lost store, a full disk, a target that cannot be written or too little memory are
    no reason to leave out an input.
    """
    if isinstance(error, AnalysisException):
        return (error.getCondition() or "").startswith(INPUT_FAULTS)
    return any(f"[{fault}" in str(error) for fault in INPUT_FAULTS)


# A layout that ends in "*.parquet" has inputs that are files or folders of that name; one
# that ends in "/" has a folder as the input, whatever the part files in it are called.
LAYOUT = "{base}/{year}/{service}/*.parquet"


def _segments(layout: str) -> list[str]:
    return layout.rstrip("/").split("/")


def _year_segment(layout: str) -> tuple[int, str]:
    """Where a layout has the year: segments from the input's end, and text before it."""
    for back, segment in enumerate(reversed(_segments(layout)), 1):
        if segment.endswith("{year}"):
            return back, segment.removesuffix("{year}")
    raise ValueError(f"no {{year}} at the end of a folder name in {layout}")


def _own_segments(layout: str) -> int:
    """How many segments at the end of a layout name an input within its year and service."""
    segments = _segments(layout)
    own = next(n for n, segment in enumerate(reversed(segments)) if "{" in segment)
    return max(own, 1)


def _end_of_path(path: Column, layout: str, segments: int) -> Column:
    """The last segments of the path of the input that a file belongs to.

    Plain text functions, as this runs for every row of a delivery.
    """
    if layout.endswith("/"):
        end = F.substring_index(path, "/", -segments - 1)
        return F.substring_index(end, "/", segments)
    return F.substring_index(F.substring_index(path, ".parquet", 1), "/", -segments)


def _unescaped(path: Column) -> Column:
    """The text of a path that Spark gives with blanks and other signs escaped.

    Most paths have none, and decoding takes longer per row than all else about them.
    """
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.when(path.contains("%"), decoded).otherwise(path)


def year_of_path(path: Column, layout: str = LAYOUT) -> Column:
    """The year a file was delivered for, as its layout gives it."""
    back, before = _year_segment(layout)
    segment = F.substring_index(_end_of_path(path, layout, back), "/", 1)
    return F.substr(segment, F.lit(len(before) + 1)).cast("int")


def source_of_path(path: Column, layout: str = LAYOUT) -> Column:
    """Name of the monthly input a file belongs to: itself, or the folder of its parts.

    ``path`` is as ``_metadata.file_path`` gives it. Folders that the layout has below year
    and service are part of the name.
    """
    own = _own_segments(layout)
    name = _unescaped(_end_of_path(path, layout, own))
    return name if own == 1 else F.replace(name, F.lit("/"), F.lit("-"))


def _end_of_input(path: str, layout: str, segments: int) -> list[str]:
    whole = path if layout.endswith("/") else path.split(".parquet")[0]
    return whole.split("/")[-segments:]


def input_year(path: str, layout: str) -> str:
    """As ``year_of_path``, for the path of one input."""
    back, before = _year_segment(layout)
    return _end_of_input(path, layout, back)[0].removeprefix(before)


def input_name(path: str, layout: str) -> str:
    """As ``source_of_path``, for the path of one input."""
    return "-".join(_end_of_input(path, layout, _own_segments(layout)))


def delivery_pattern(base: str, service: str, year: str, layout: str) -> str:
    """Glob for the files of a delivery."""
    pattern = layout.format(base=base.rstrip("/"), year=year, service=service)
    return f"{pattern}*.parquet" if layout.endswith("/") else pattern


def unit_of(layout: str) -> str:
    """How a layout tells a file's input from its path."""
    return PARENT_FOLDER if layout.endswith("/") else WHOLE_INPUT


def find_service_inputs(
    spark: SparkSession,
    base: str,
    years: Iterable[int | str],
    services: Sequence[str],
    layout: str = LAYOUT,
    *,
    stats: bool = False,
) -> dict[str, list[Input]]:
    """Inputs of the given years per service; what is missing is warned about."""
    years = [str(y) for y in years]
    found = {}
    for service in services:
        pattern = delivery_pattern(base, service, "{" + ",".join(years) + "}", layout)
        inputs = list_inputs(spark, pattern, unit_of(layout), stats=stats)
        counts = Counter(input_year(item.path, layout) for item in inputs)
        for year in years:
            if counts[year]:
                log.info("%d inputs for %s %s", counts[year], service, year)
            else:
                log.warning("no inputs for %s %s below %s", service, year, base)
        if inputs:
            found[service] = inputs
    if not found:
        log.warning("no inputs at all below %s", base)
    return found


class DriftError(ValueError):
    """Inputs whose values of one column no common type holds without loss."""


# Whole numbers up to this size, and decimals of up to so many digits, are doubles exactly.
EXACT_WHOLE = 2**53
EXACT_DIGITS = 15


def _common_type(kinds: set[DataType]) -> DataType | None:
    """A type for all of ``kinds``, None if there is none.

    With floating numbers among them it is double, whether or not it holds all values.
    """
    kinds = {k for k in kinds if not isinstance(k, NullType)} or kinds
    if len(kinds) == 1:
        return next(iter(kinds))
    if all(isinstance(k, IntegralType) for k in kinds):
        return LongType()
    if all(isinstance(k, (IntegralType, DecimalType)) for k in kinds):
        exact = [_as_decimal(k) for k in kinds]
        scale = max(k.scale for k in exact)
        digits = max(k.precision - k.scale for k in exact) + scale
        return DecimalType(digits, scale) if digits <= 38 else None
    if all(isinstance(k, NumericType) for k in kinds):
        return DoubleType()
    if all(isinstance(k, (TimestampType, TimestampNTZType)) for k in kinds):
        return TimestampNTZType()
    return None


def _as_decimal(kind: DataType) -> DecimalType:
    return kind if isinstance(kind, DecimalType) else DecimalType(19, 0)


def _lossy(value: Column, kind: DataType) -> Column | None:
    """Whether a number is no double; None if every number of its type is one."""
    if isinstance(kind, LongType):
        return ~value.between(-EXACT_WHOLE, EXACT_WHOLE)
    if isinstance(kind, DecimalType) and kind.precision > EXACT_DIGITS:
        return ~value.cast("double").try_cast(kind).eqNullSafe(value)
    return None


def _refuse_loss(frames: Sequence[DataFrame], kinds: Mapping[str, DataType]) -> None:
    """One pass over the columns that become double, if any need it; an error if one loses digits."""
    checks = []
    for frame in frames:
        own = {}
        for field in frame.schema.fields:
            if isinstance(kinds[field.name.lower()], DoubleType):
                lossy = _lossy(F.col(f"`{field.name}`"), field.dataType)
                if lossy is not None:
                    own[field.name] = lossy
        if own:
            checks.append((frame, own))
    if not checks:
        return
    counts = [
        frame.agg(*[F.count_if(lossy).alias(str(i)) for i, lossy in enumerate(own.values())])
        .select(F.lit(n).alias("frame"), F.array("*").alias("counts"))
        for n, (frame, own) in enumerate(checks)
    ]
    together = counts[0]
    for part in counts[1:]:
        together = together.unionByName(part)
    for row in together.where(F.exists("counts", lambda c: c > 0)).limit(1).collect():
        frame, own = checks[row.frame]
        name, lossy = next((n, x) for (n, x), c in zip(own.items(), row.counts) if c)
        first = frame.where(lossy).select(F.input_file_name(), F.col(f"`{name}`").cast("string")).first()
        raise DriftError(
            f"column {name} is a whole number or decimal in one input and floating in another, "
            f"and {first[1]} is no double: {unquote(first[0])}"
        )


def union_drifted(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of frames that differ in columns, types or letter case of names.

    A column takes a type that holds every input's values: whole numbers are long, whole
    numbers and decimals a decimal wide enough, and with floating numbers among them
    double. Where long or decimal values become double, one pass over those columns alone
    proves that none loses a digit. What no type holds is a ``DriftError`` that names the
    column and an input: such inputs are to be told apart, not to become text. Where an
    input lacks a column, it is null.
    """
    names: dict[str, str] = {}
    found: dict[str, dict[DataType, DataFrame]] = {}
    for frame in frames:
        for field in frame.schema.fields:
            key = field.name.lower()
            names.setdefault(key, field.name)
            found.setdefault(key, {}).setdefault(field.dataType, frame)
    kinds: dict[str, DataType] = {}
    for key, types in found.items():
        common = _common_type(set(types))
        if common is None:
            where = ", ".join(f"{k.simpleString()} in {_an_input(f)}" for k, f in types.items())
            raise DriftError(f"column {names[key]} has no common type: {where}")
        kinds[key] = common
    _refuse_loss(frames, kinds)
    aligned = []
    for frame in frames:
        own = {c.lower() for c in frame.columns}
        columns = []
        for key, name in names.items():
            value = F.col(f"`{name}`") if key in own else F.lit(None)
            columns.append(value.cast(kinds[key]).alias(name))
        aligned.append(frame.select(*columns))
    out = aligned[0]
    for frame in aligned[1:]:
        out = out.unionByName(frame)
    return out


def _an_input(frame: DataFrame) -> str:
    return next((unquote(f) for f in frame.inputFiles()[:1]), "a frame without files")
