"""Byte-level BPE: texts to token ids and back, many pieces at a time in numpy matrices.

A vocabulary is a file of byte strings and ranks. A pattern splits a text into pieces,
and each piece is encoded by itself: a piece that is a token is that token; any other
starts as single bytes and merges, again and again, the leftmost of its adjacent pairs
whose joined bytes have the lowest rank, until no pair is a token.

The distinct pieces of a batch are dealt into buckets by length, each a padded matrix with
a row for each piece. In one round every row merges its leftmost minimum-rank pair: the
row closes the gap, the two pairs beside it are looked up anew in a hash table of pairs,
and the matrix loses a column, as every row has become one shorter. Rows without a pair
left are finished and leave the matrix. Pieces above ``LONG`` bytes are rows of their own;
in them a round merges all pairs of the lowest rank at once, where it is certain that one
by one would give the same, and else the leftmost one.

Tasks work on their own rows; nothing is shuffled. Each worker loads the vocabulary file
from ``path``, which every executor must have.

Defined results: null and empty texts have no ids and decode to no bytes. Very long texts
and pieces are encoded whole. Rows are encoded each, repeated ones and null ids too. Only
the id and the text (for decoding the ids) are read, so other columns may have any name.
An empty table gives an empty one. Null ids decode to null; an id that is no token is an
error.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField, StructType

from meterline.llm.common import in_groups

#: Rank of a pair that is no token.
NONE = np.int32(2**31 - 1)
#: Bytes of a piece beyond which it is a row of its own.
LONG = 256
#: Bytes of text, and of ids, that are worked on at a time.
GROUP = 4 << 20


class Pairs:
    """A hash table from pairs of ids to the id of their joined bytes; linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray):
        self._bits = max(8, int(4 * len(left)).bit_length())
        size = 1 << self._bits
        self._keys = np.full(size, -1, dtype=np.int64)
        self._values = np.full(size, NONE, dtype=np.int32)
        keys = self._key(left, right)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self._keys[at[todo]] == -1
            self._keys[at[todo[free]]] = keys[todo[free]]  # of several at one slot, one stays
            placed = self._keys[at[todo]] == keys[todo]
            self._values[at[todo[placed]]] = joined[todo[placed]]
            todo = todo[~placed]
            at[todo] = (at[todo] + 1) & (size - 1)

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.int64) << 32) | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - self._bits)).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of the joined pairs; ``NONE`` where they are no token or an id is below 0."""
        out = np.full(left.shape, NONE, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = self._key(left.reshape(-1)[todo], right.reshape(-1)[todo])
        at, flat = self._slot(keys), out.reshape(-1)
        while len(todo):
            there = self._keys[at]
            hit = there == keys
            flat[todo[hit]] = self._values[at[hit]]
            on = ~hit & (there != -1)
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & (len(self._keys) - 1)
        return out


class Vocabulary:
    """Tokens by id, and the ids of pieces. ``pattern`` splits texts into pieces."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        size = max(self.ranks.values()) + 1
        tokens = [b""] * size
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self._lengths = np.array([len(t) for t in tokens], dtype=np.int64)
        self._starts = np.cumsum(self._lengths) - self._lengths
        self._bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self._singles = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        split = [
            (self.ranks[token[:k]], self.ranks[token[k:]], rank)
            for token, rank in self.ranks.items()
            for k in range(1, len(token))
            if token[:k] in self.ranks and token[k:] in self.ranks
        ]
        self._pairs = Pairs(*np.array(split or [(-1, -1, -1)], dtype=np.int64).T)
        self._pieces = regex.compile(pattern).findall
        self._known: dict[str, bytes] = {}

    # encoding

    def encode(self, texts: list[str], remember: int = 300_000) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and the number of ids of each text.

        The ids of a piece are remembered until ``remember`` pieces are known.
        """
        cut = [self._pieces(text) for text in texts]
        if len(self._known) > remember:
            self._known.clear()
        new = list({p for pieces in cut for p in pieces}.difference(self._known))
        self._known.update(zip(new, self.encode_pieces([p.encode("utf-8") for p in new])))
        known = self._known.__getitem__
        ids = [b"".join(map(known, pieces)) for pieces in cut]
        return np.frombuffer(b"".join(ids), dtype="<i4"), np.array([len(x) // 4 for x in ids], dtype=np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ranks.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > LONG:
                ids = self._singles[np.frombuffer(piece, dtype=np.uint8)]
                out[i] = self._merge_long(ids).astype("<i4").tobytes()
            elif piece:
                buckets.setdefault((len(piece) - 1).bit_length(), []).append(i)
        for numbers in buckets.values():
            for some in in_groups(numbers, lambda i: 8 * len(pieces[i]), GROUP):
                for i, ids in zip(some, self._merge_rows([pieces[i] for i in some])):
                    out[i] = ids
        return out

    def _merge_rows(self, pieces: list[bytes]) -> list[bytes]:
        lengths = np.array([len(p) for p in pieces])
        width = int(lengths.max())
        inside = np.arange(width) < lengths[:, None]
        ids = np.full((len(pieces), width), -1, dtype=np.int32)
        ids[inside] = self._singles[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        ranks = self._pairs(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(pieces))
        out = [b""] * len(pieces)
        while True:
            # One column more, so that a row always has a pair to look at.
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(row), dtype=np.int64)
            least = ranks[np.arange(len(row)), at] if ranks.shape[1] else np.full(len(row), NONE)
            merging = least < NONE
            for i in np.flatnonzero(~merging):
                out[row[i]] = ids[i][ids[i] >= 0].astype("<i4").tobytes()
            if not merging.any():
                return out
            row, ids, ranks, at, least = (x[merging] for x in (row, ids, ranks, at, least))
            lines, columns = np.arange(len(row)), np.arange(ids.shape[1] - 1)
            ids[lines, at] = least
            ids = np.take_along_axis(ids, columns + (columns > at[:, None]), axis=1)
            columns = columns[:-1]
            ranks = np.take_along_axis(ranks, columns + (columns >= at[:, None]), axis=1)
            for beside in (at - 1, at):
                there = np.flatnonzero((beside >= 0) & (beside < ranks.shape[1]))
                place = beside[there]
                ranks[there, place] = self._pairs(ids[there, place], ids[there, place + 1])

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        ranks = self._pairs(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) < NONE:
            at = np.flatnonzero(ranks == least)
            # Of pairs that overlap in a chain, every second one from its start.
            first = np.diff(at, prepend=-2) > 1
            place = np.arange(len(at))
            begun = np.maximum.accumulate(np.where(first, place, 0))
            at = at[(place - begun) % 2 == 0]
            # What stands beside each new token the moment it is made: to the right
            # the old id, to the left perhaps a new token.
            padded = np.concatenate(([-1, -1], ids, [-1]))
            left = np.where(np.diff(at, prepend=-9) == 2, least, padded[at + 1])
            new = np.full(len(at), least, dtype=np.int32)
            if min(self._pairs(left, new).min(), self._pairs(new, padded[at + 4]).min()) < least:
                at = at[:1]
            ids = ids.copy()
            ids[at] = least
            stays = np.ones(len(ids), dtype=bool)
            stays[at + 1] = False
            ids = ids[stays]
            at = at - np.arange(len(at))
            kept = np.ones(len(ranks), dtype=bool)
            kept[np.flatnonzero(~stays) - 1] = False
            ranks = ranks[kept]
            for beside in (at - 1, at):
                beside = beside[(beside >= 0) & (beside < len(ranks))]
                ranks[beside] = self._pairs(ids[beside], ids[beside + 1])
        return ids

    # decoding

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids in a row, and the number of bytes of each id."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self._lengths) and self._lengths[ids].all()):
            raise ValueError("an id that is no token of the vocabulary")
        lengths = self._lengths[ids]
        ends = np.cumsum(lengths)
        shift = np.repeat(self._starts[ids] - (ends - lengths), lengths)
        return self._bytes[shift + np.arange(len(shift))], lengths


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for each worker process."""
    return Vocabulary(path, pattern)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _offsets(counts: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(counts)))


def encode_texts(
    docs: DataFrame, *, path: str | None = None, pattern: str | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, ids): the token ids of every text."""
    path, pattern = path or default_path(), pattern or default_pattern()
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = StructType([rows.schema[0], StructField("ids", ArrayType(IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            done = 0
            for group in in_groups(batch.column(1), lambda x: 4 * len(x.as_buffer()), 4 * GROUP):
                ids, counts = words.encode([x.as_py() for x in group])
                lists = pa.LargeListArray.from_arrays(pa.array(_offsets(counts)), pa.array(ids, pa.int32()))
                keys = batch.column(0).slice(done, len(group))
                done += len(group)
                yield pa.RecordBatch.from_arrays([keys, lists.cast(pa.list_(pa.int32()))], names=[key, "ids"])

    return rows.mapInArrow(run, schema)


def decode_ids(
    encoded: DataFrame, *, path: str | None = None, pattern: str | None = None, key: str = "doc_id", ids: str = "ids"
) -> DataFrame:
    """(key, ids, decoded): the bytes that every list of ids stands for."""
    path, pattern = path or default_path(), pattern or default_pattern()
    rows = encoded.select(F.col(key), F.col(ids))
    schema = StructType([*rows.schema.fields, StructField("decoded", BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path, pattern)
        for batch in batches:
            done = 0
            for group in in_groups(batch.column(1), lambda x: 16 * len(x.values or ()), 4 * GROUP):
                part = batch.slice(done, len(group))
                done += len(group)
                lists = part.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                data, lengths = words.decode(flat.astype(np.int64))
                ends = _offsets(lengths)[_offsets(np.array([len(x.values or ()) for x in group]))]
                whole = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(group), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)]
                )
                valid = pa.array(lists.is_valid())
                decoded = pc.if_else(valid, whole, pa.scalar(None, pa.large_binary())).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)
