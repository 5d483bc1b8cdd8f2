"""What several operators share: tables, words, ranks, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterline.session import stored

#: A word is a run of bytes other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only, as the contracts say."""
    return F.translate(text, _UPPER, _UPPER.lower())


#: Lower-cases A-Z and makes the six white-space characters blanks.
_PLAIN = bytes(32 if c in b" \t\n\r\x0b\x0c" else c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Random numbers for a byte at a place of a word.
_AT = np.random.default_rng(17).integers(0, 2**63, size=(256, 32), dtype=np.uint64)


def plain_bytes(text) -> bytes:
    """A text with A-Z lower-cased and its words between blanks; null is empty."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN) if isinstance(text, str) else b""


def word_hashes(buffers: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Hashes of the blank-separated words of all buffers, the number of words of each
    buffer, and where each word starts in the buffers joined by blanks.

    A hash is a sum over the bytes of random numbers by byte and place, so the whole batch
    is one pass of array operations and words never become objects.
    """
    joined = b" " + b" ".join(buffers) + b" "
    a = np.frombuffer(joined, dtype=np.uint8)
    blank = a == 32
    starts = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
    ends = 1 + np.cumsum([len(b) + 1 for b in buffers])
    counts = np.diff(np.searchsorted(starts, ends), prepend=0) if buffers else np.zeros(0, dtype=np.int64)
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts, starts, joined
    begun = np.zeros(len(a), dtype=np.int32)
    begun[starts] = starts
    place = np.arange(len(a), dtype=np.int32) - np.maximum.accumulate(begun)
    parts = _AT[a, place & 31]
    if place.max() >= 32:
        parts *= (2 * (place >> 5) + 1).astype(np.uint64)
    parts[blank] = 0
    return mixed(np.add.reduceat(parts, starts)), counts, starts, joined


def in_groups(items, size, most: int = 1 << 20):
    """Lists of consecutive items whose sizes add up to about ``most``."""
    group: list = []
    held = 0
    for item in items:
        group.append(item)
        held += size(item)
        if held >= most:
            yield group
            group, held = [], 0
    if group:
        yield group


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; one-to-one."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def shingle_runs(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words, in place order; fewer words make one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    take = min(width, n)
    runs = np.zeros(n - take + 1, dtype=np.uint64)
    for i in range(take):
        runs = mixed(runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - take + 1 + i])
    if n < width:
        runs = runs + np.uint64(n)
    return runs


def shingle_set(hashes: np.ndarray, width: int) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words make one run."""
    return np.unique(shingle_runs(hashes, width))


def ranked(df: DataFrame, *order: str, name: str = "ranked", column: str = "rank") -> DataFrame:
    """``df`` with its row number from 0 in the order of the columns, without one big sort.

    Rows are range-partitioned and stored; each partition numbers its own rows from an
    offset. Only one count for each partition reaches the driver.
    """
    parts = stored(
        df.repartitionByRange(*[F.col(c) for c in order]).withColumn(
            "_part", F.spark_partition_id()
        ),
        name,
    )
    counts = sorted((r["_part"], r["count"]) for r in parts.groupBy("_part").count().collect())
    offsets, total = [], 0
    for part, count in counts:
        offsets.append((part, total))
        total += count
    starts = df.sparkSession.createDataFrame(offsets, "_part int, _start long")
    inside = Window.partitionBy("_part").orderBy(*order)
    return (
        parts.join(F.broadcast(starts), "_part")
        .withColumn(column, F.row_number().over(inside) - 1 + F.col("_start"))
        .drop("_part", "_start")
    )


#: File names that are broadcast at most, some 20 MB; more are joined by a shuffle.
MOST_FILES = 100_000
#: Numbers of rows that are broadcast at most, some 20 MB; more are joined by a shuffle.
MOST_KEYS = 1_000_000


def small(keys: DataFrame) -> DataFrame:
    """``keys``, a frame of one number a row, broadcast where they are few.

    The other side of a join then stays where it is; it holds the texts here.
    """
    return F.broadcast(keys) if keys.count() <= MOST_KEYS else keys


def numbered(docs: DataFrame, name: str = "numbered", column: str = "_row") -> DataFrame:
    """``docs`` with a number of its own for every row, whatever its id is.

    Rows of Parquet files are numbered by file and place in it, without reading or storing
    them; only the files' names reach the driver. Any other frame is stored with numbers.
    The numbers stay the same when tasks run again.
    """
    try:
        places = docs.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    except AnalysisException:
        return stored(docs.withColumn(column, F.monotonically_increasing_id()), name)
    files = sorted(r[0] for r in places.select("_file").distinct().collect())
    numbers = docs.sparkSession.createDataFrame(list(enumerate(files)), f"{column}_file long, _file string")
    if len(files) <= MOST_FILES:
        numbers = F.broadcast(numbers)
    row = F.shiftleft(F.col(f"{column}_file"), 40) + F.col("_place")
    return places.join(numbers, "_file").select(*[docs[c] for c in docs.columns], row.alias(column))


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id that edges ``a``-``b`` connect each id with.

    Alternates two steps until nothing changes: each vertex passes its smallest
    neighbour to its larger neighbours, then each passes it to its smaller ones, so paths
    halve as in pointer jumping and every edge list stays linear. Each round is stored in
    the shared folder. Ids without edges are absent; an empty input gives an empty result.
    """
    edges = stored(
        edges.where("a <> b")
        .select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))
        .distinct(),
        name,
    )
    for _ in range(rounds):
        both = edges.select(F.col("lo").alias("v"), F.col("hi").alias("u")).union(
            edges.select(F.col("hi").alias("v"), F.col("lo").alias("u"))
        )
        least = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("m"))
        large = (
            both.where("u > v").join(least, "v").select(F.col("m").alias("lo"), F.col("u").alias("hi"))
        ).distinct()
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        moved = large.join(least, "hi")
        new = stored(
            moved.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
            .where("lo <> hi")
            .union(least.select(F.col("m").alias("lo"), "hi"))
            .distinct(),
            name,
        )
        same = _mark(new) == _mark(edges)
        edges = new
        if same:
            break
    else:
        raise RuntimeError("components did not settle")
    ids = edges.select(F.col("hi").alias("id"), F.col("lo").alias("component"))
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return ids.union(roots)


def _mark(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.bit_xor(F.xxhash64("lo", "hi")), F.sum(F.hash("lo", "hi").cast("long"))).first()
    )


class Links:
    """Union-find over positions 0..n-1; the smallest position is the root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.root(i), self.root(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def key_lists(batches, keys: tuple[str, ...], columns: tuple[str, ...]) -> Iterator[list[tuple]]:
    """Lists of the rows with equal keys, from batches sorted by them."""
    now, rows = None, []
    for batch in batches:
        marks = list(zip(*(batch[k].tolist() for k in keys)))
        for mark, row in zip(marks, zip(*(batch[c].tolist() for c in columns))):
            if mark != now:
                if rows:
                    yield rows
                now, rows = mark, []
            rows.append(row)
    if rows:
        yield rows
