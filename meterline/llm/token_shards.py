"""Token ids in training order: a keyed Feistel permutation and fixed-stride shards.

Texts are encoded with a public byte-level vocabulary, closed with an end mark and cut
into sequences of ``stride`` ids (the last one padded). Sequences are numbered by task
and position, then a keyed Feistel network with cycle-walking maps the numbers onto
global slots 0..N-1, one to one. Range partitions of the slots become shards: rows that
hold ``shard_rows`` records of ``2 * stride`` bytes each, little-endian, in slot order. A
reader finds slot s in shard ``s // shard_rows`` at byte ``(s % shard_rows) * 2 * stride``
and can go on from any slot.

Encoding runs once; its result is stored, so numbers and ids stay together when
executors are lost. The number of a sequence follows from the input's splits: the same
files, split size and key give the same order.

Defined results: null texts have no sequence, empty ones have one with the end mark only.
Repeated rows are encoded each. Null ids stay null. An empty table gives no shard. Very
long texts are encoded in pieces. Only the id and the text are read.
"""

from __future__ import annotations

import base64
import functools
import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterline.llm.common import key_lists
from meterline.session import new_folder

VOCABULARY = os.environ.get("TOKENIZER_FILE", "/opt/tokenizers/byte_bpe_50k.tiktoken")
#: Fixed value: the word pattern of this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256


@functools.lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("shards", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=1)
def _latin_words() -> Callable[[str], list[str]]:
    """The words of ``PATTERN``, and written like it, in a text of code points below 256.

    Over so few characters the classes can be spelled out, and Python's own engine, which
    has no classes of Unicode, takes half the time.
    """
    import regex

    def having(kind: str) -> str:
        return "".join(f"\\x{i:02x}" for i in range(256) if regex.match(kind, chr(i)))

    letters, numbers, spaces = map(having, (r"\p{L}", r"\p{N}", r"\s"))
    return re.compile(
        rf"'(?:[sdmt]|ll|ve|re)| ?[{letters}]+| ?[{numbers}]+| ?[^{spaces}{letters}{numbers}]+"
        rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    ).findall


class _Words(dict):
    """Little-endian 16-bit ids of words, encoded when they are first met."""

    def __init__(self, encode: Callable[[str], list[int]]):
        self._encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = array("H", self._encode(word))
        if sys.byteorder == "big":
            ids.byteswap()
        self[word] = ids.tobytes()
        return self[word]


class Encoder:
    """Ids of a text; the ids of a word are remembered up to a bound."""

    def __init__(self, path: str = VOCABULARY, limit: int = 300_000):
        import regex

        self._encoding = _encoding(path)
        self._words = regex.compile(PATTERN).findall
        self._latin_words = _latin_words()
        self._known = _Words(self._encoding.encode_ordinary)
        self._limit = limit

    def words(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._words(text)
        return self._latin_words(text)

    def __call__(self, text: str) -> bytes:
        """Little-endian 16-bit ids."""
        known = self._known
        if len(known) > self._limit:
            known.clear()
        return b"".join(map(known.__getitem__, self.words(text)))

    def decode(self, ids: np.ndarray) -> str:
        return self._encoding.decode([int(i) for i in ids if i != END])


def feistel(index: np.ndarray, size: int, key: int, rounds: int = 4) -> np.ndarray:
    """A keyed permutation of 0..size-1: values that leave the range walk on along their cycle."""
    half = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    walking = np.ones(len(out), dtype=bool)
    while walking.any():
        x = out[walking]
        left, right = x >> np.uint64(half), x & mask
        for r in range(rounds):
            m = right + np.uint64((key * 0x9E3779B97F4A7C15 + r * 0xC2B2AE3D27D4EB4F) & (2**64 - 1))
            for _ in range(2):
                m = (m ^ (m >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((m ^ (m >> np.uint64(29))) & mask)
        out[walking] = (left << np.uint64(half)) | right
        walking = out >= np.uint64(size)
    return out.astype(np.int64)


def _sequences(path: str, stride: int) -> Callable:
    def run(batches):
        encode = Encoder(path)
        task, number = TaskContext.get().partitionId(), 0
        width = 2 * stride
        end = np.array([END], dtype="<u2").tobytes()
        columns = ["task", "number", "doc_id", "part", "n_tokens", "ids"]
        for batch in batches:
            rows: list = []
            for doc, text in zip(batch["key"].tolist(), batch["text"].tolist()):
                if not isinstance(text, str):
                    continue
                doc = None if pd.isna(doc) else int(doc)
                ids = encode(text) + end
                for part, at in enumerate(range(0, len(ids), width)):
                    piece = ids[at : at + width]
                    rows.append((task, number, doc, part, len(piece) // 2, piece))
                    number += 1
                if len(rows) >= 10_000:
                    yield pd.DataFrame(rows, columns=columns).astype({"doc_id": "Int64"})
                    rows = []
            yield pd.DataFrame(rows, columns=columns).astype(
                {"task": "int32", "number": "int64", "doc_id": "Int64", "part": "int32", "n_tokens": "int32"}
            )

    return run


def slot(number: Column, size: int, key: int) -> Column:
    @F.pandas_udf("long")
    def permute(n: pd.Series) -> pd.Series:
        return pd.Series(feistel(n.to_numpy(), size, key))

    return permute(number)


def write_shards(
    docs: DataFrame,
    folder: str | None = None,
    *,
    key: str = "doc_id",
    text: str = "text",
    stride: int = 512,
    shard_rows: int = 2048,
    seed: int = 20240501,
    vocabulary: str = VOCABULARY,
) -> DataFrame:
    """Writes the shards and returns them as a frame: shard, first_slot, records, and the
    ids, documents, parts and lengths of the records in slot order."""
    spark: SparkSession = docs.sparkSession
    folder = folder or new_folder(spark, "token-shards")
    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    made = pairs.mapInPandas(
        _sequences(vocabulary, stride),
        "task int, number long, doc_id long, part int, n_tokens int, ids binary",
    )
    sequences = new_folder(spark, "token-sequences")
    made.write.option("compression", "zstd").parquet(sequences)
    made = spark.read.schema(made.schema).parquet(sequences)
    # One count for each task of the encoding.
    starts, total = [], 0
    for task, count in sorted((r["task"], r["count"]) for r in made.groupBy("task").count().collect()):
        starts.append((task, total))
        total += count
    offsets = spark.createDataFrame(starts, "task int, start long")
    placed = made.join(F.broadcast(offsets), "task").withColumn(
        "slot", slot(F.col("start") + F.col("number"), max(total, 1), seed)
    )
    placed = placed.withColumn("shard", F.expr(f"slot div {shard_rows}"))

    def pack(batches):
        columns = ("shard", "slot", "doc_id", "part", "n_tokens", "ids")
        for rows in key_lists(batches, ("shard",), columns):
            body = b"".join(
                r[5] + np.full(stride - len(r[5]) // 2, END, dtype="<u2").tobytes() for r in rows
            )
            yield pd.DataFrame(
                {
                    "shard": [rows[0][0]],
                    "first_slot": [rows[0][1]],
                    "records": [len(rows)],
                    "docs": [[None if pd.isna(r[2]) else int(r[2]) for r in rows]],
                    "parts": [[r[3] for r in rows]],
                    "lengths": [[r[4] for r in rows]],
                    "body": [body],
                }
            )

    shards = max(1, -(-total // shard_rows))
    width = max(1, min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 16)))
    packed = (
        placed.select("shard", "slot", "doc_id", "part", "n_tokens", "ids")
        .repartitionByRange(width, "shard")
        .sortWithinPartitions("shard", "slot")
        .mapInPandas(
            pack,
            "shard long, first_slot long, records int, docs array<long>, parts array<int>, "
            "lengths array<int>, body binary",
        )
    )
    packed.write.option("compression", "zstd").parquet(folder)
    return spark.read.schema(packed.schema).parquet(folder)


def read_records(shards: DataFrame, stride: int = 512) -> DataFrame:
    """One row per record of written shards: slot, shard, offset, document, part, length, digest."""

    def run(batches):
        import xxhash

        for batch in batches:
            for s in batch.itertuples(index=False):
                size = 2 * stride
                at = np.arange(s.records) * size
                yield pd.DataFrame(
                    {
                        "slot": s.first_slot + np.arange(s.records),
                        "shard": s.shard,
                        "byte_offset": at,
                        "doc_id": pd.array([None if pd.isna(d) else int(d) for d in s.docs], dtype="Int64"),
                        "part": np.asarray(s.parts, dtype=np.int32),
                        "n_tokens": np.asarray(s.lengths, dtype=np.int32),
                        "digest": [
                            xxhash.xxh3_64_intdigest(s.body[a : a + size]) >> 1 for a in at.tolist()
                        ],
                    }
                )

    return shards.mapInPandas(
        run,
        "slot long, shard long, byte_offset long, doc_id long, part int, n_tokens int, digest long",
    )
