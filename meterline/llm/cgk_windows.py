"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and items become normalised words with single blanks, read as characters. A window of
a text starts at every ``step``-th character; an item is entered with every start, so that
several of them stand exactly at windows of any text that quotes it, and the number of
windows grows with the item: edits in one part leave the others. The CGK random walk reads
symbol i, writes it, and moves on or stays by a random bit of (symbol, place); it maps edit
distance to Hamming distance with a distortion that depends on the distance alone. Only
the sampled places of the walk are hashed: each repetition has its own walk and ``bands``
samples of ``sampled`` places. The repetitions were set for a recall of 0.95 and more at
similarity 0.8 on items of 15 words and more. A window whose key an item has is a candidate.
The least edits of the parts of an item add up to a lower bound, which leaves out what cannot
be near; the others are aligned with the text around them: Sellers' algorithm gives the least
number of character edits between the whole item and any part of the text. It is a leak at
``1 - edits / len(item) >= similarity``.

Items below ``short_chars`` characters have few windows. They are cut into one piece more
than the edits they may have, so one piece is unchanged in any leak: its places are the
candidates, and nothing is lost. They must stand as words: the blanks around them are
aligned too, but do not count in the length, so an item of under five characters is found
as an exact word sequence.

Items go to the tasks in blocks with a bound on rows and characters (``item_block``,
``block_chars``); more items mean more passes, never a larger broadcast.

Defined results: null and empty texts and items match nothing. Repeated rows are judged
alike. Other columns are not read. Recall on planted edits is measured in the tests.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import in_groups, mixed

_KEEP = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def letters(text) -> bytes:
    """Lower-case text with blanks for ASCII punctuation and white space; null is empty."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_KEEP) if isinstance(text, str) else b""


def plain_text(words: bytes) -> str:
    """Words with single blanks between them."""
    return b" ".join(words.split()).decode("utf-8", "replace")


class Plan:
    """Which places of which walk each key hashes; the same on both sides.

    Places are drawn one from each of ``sampled`` strata. A walk may stay on a character for
    many places; keys that saw fewer than ``distinct`` characters say little and are dropped
    on both sides alike, other windows and bands take their part.
    """

    def __init__(self, walks: int, bands: int, sampled: int, length: int, distinct: int, seed: int):
        self.length, self.distinct = length, distinct
        rng = np.random.default_rng(seed)
        edges = np.linspace(0, length, min(sampled, length) + 1).astype(int)
        # Bands by place: the bands whose keys hash this place of a walk.
        self.at = [[[] for _ in range(length)] for _ in range(walks)]
        for walk in range(walks):
            for band in range(bands):
                for a, b in zip(edges, edges[1:]):
                    self.at[walk][int(rng.integers(a, b))].append(band)
        codes = np.arange(0x110000, dtype=np.uint64)
        self.bits = [mixed(mixed(codes + np.uint64((walk + 1) << 32))).astype(np.uint32) for walk in range(walks)]

    def keys(self, symbols: np.ndarray, starts: np.ndarray, most: int = 1 << 15):
        """(rows, keys) of the windows at ``starts``, for each walk and band. ``symbols`` has
        ``length`` more places behind the last start."""
        for walk, bits in enumerate(self.bits):
            here_of = bits[symbols]
            for first in range(0, len(starts), most):
                at = starts[first : first + most]
                sums: dict = {}
                for place in range(self.length):
                    here = here_of.take(at)
                    for band in self.at[walk][place]:
                        if band in sums:
                            s, last, seen = sums[band]
                            s *= np.uint32(0x9E3779B1)
                            s += here
                            seen += at != last
                            sums[band] = s, at, seen
                        else:
                            sums[band] = here.copy(), at, np.ones(len(at), dtype=np.uint8)
                    at = at + ((here >> np.uint32(place)) & np.uint32(1))
                for band, (s, _, seen) in sums.items():
                    good = np.flatnonzero(seen >= self.distinct)
                    yield good + first, _spread(s[good] ^ np.uint32((walk * 64 + band + 1) * 0x85EBCA6B & 0xFFFFFFFF))


def _spread(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 32-bit numbers; one-to-one."""
    x = x ^ (x >> np.uint32(15))
    x = x * np.uint32(0x2C1B3C6D)
    return x ^ (x >> np.uint32(13))


def _symbols(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)


def _grams(symbols: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` symbols at every place."""
    n = max(0, len(symbols) - width + 1)
    out = np.full(n, width, dtype=np.uint32)
    for i in range(width):
        out *= np.uint32(0x9E3779B1)
        out += symbols[i : i + n]
    return _spread(out)


class Seeds:
    """Sorted keys with the item and the offset of each; a bit table answers most lookups."""

    BITS = np.uint32((1 << 22) - 1)

    def __init__(self, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        empty = (np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys, owners, offsets = map(np.concatenate, zip(empty, *parts))
        order = np.argsort(keys, kind="stable")
        self.keys, self.owners, self.offsets = keys[order], owners[order], offsets[order]
        self.table = np.zeros(1 << 22, dtype=bool)
        self.table[self.keys & self.BITS] = True

    def hits(self, found: np.ndarray, most: int = 1 << 20):
        """(row of ``found``, item, offset) of equal keys, about ``most`` at a time."""
        rows = np.flatnonzero(self.table.take(found & self.BITS))
        a = np.searchsorted(self.keys, found[rows], "left")
        counts = np.searchsorted(self.keys, found[rows], "right") - a
        upto = np.cumsum(counts)
        first = 0
        while first < len(rows):
            before = upto[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(upto, before + most)))
            n = counts[first:last]
            e = np.repeat(a[first:last] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield np.repeat(rows[first:last], n), self.owners[e], self.offsets[e]
            first = last


def least_edits(item: str, text: str) -> int:
    """The least number of edits between ``item`` and any part of ``text``."""
    return _aligned(item, text)[0]


def _aligned(item: str, text: str) -> tuple[int, int]:
    """The least number of edits and where the first such part of ``text`` ends: Sellers'
    table, a column at a time as two bit vectors (Myers)."""
    if item in text:
        return 0, text.index(item) + len(item)
    size = len(item)
    full, top = (1 << size) - 1, 1 << (size - 1)
    where: dict[str, int] = {}
    for i, ch in enumerate(item):
        where[ch] = where.get(ch, 0) | 1 << i
    up, down, edits = full, 0, size
    least, end = size, 0
    for place, ch in enumerate(text, 1):
        match = where.get(ch, 0)
        diagonal = match | down
        level = (((match & up) + up) ^ up) | match
        rise = down | (full & ~(level | up))
        fall = up & level
        if rise & top:
            edits += 1
        elif fall & top:
            edits -= 1
            if edits < least:
                least, end = edits, place
        rise = (rise << 1) & full
        fall = (fall << 1) & full
        up = fall | (full & ~(diagonal | rise))
        down = rise & diagonal
    return least, end


#: Characters of one class count as equal in the bound of ``may_be_near``.
_CLASSES = 128
#: Candidates of one text and item whose starts differ by less are aligned once.
_NEAR = 16


class Items:
    """A block of items with what is needed to find and to judge them."""

    def __init__(self, items: list[tuple[int, str]], plan: Plan, similarity: float, short_chars: int):
        named = [(i, plain_text(letters(t))) for i, t in items]
        named = [(i, t) for i, t in named if t]
        self.ids = [i for i, _ in named]
        self.sizes = np.array([len(t) for _, t in named], dtype=np.int64)
        self.most = ((1 - similarity) * self.sizes + 1e-9).astype(np.int64)
        self.short = self.sizes < short_chars
        self.plain = [f" {t} " if short else t for (_, t), short in zip(named, self.short)]
        self.spans = self.sizes + 2 * self.short
        # Parts of at most 64 characters: the bits where a class of characters stands.
        self.parts = -(-self.spans // 64)
        self.first = np.cumsum(self.parts) - self.parts
        self.where = np.zeros((int(self.parts.sum()), _CLASSES), dtype=np.uint64)
        walked, pieces = [], {}
        for owner, text in enumerate(self.plain):
            symbols = _symbols(text)
            part = np.arange(len(symbols)) * self.parts[owner] // len(symbols)
            bit = np.arange(len(symbols)) - np.searchsorted(part, part)
            np.bitwise_or.at(
                self.where, (self.first[owner] + part, symbols % _CLASSES), np.uint64(1) << bit.astype(np.uint64)
            )
            if self.short[owner]:
                cuts = np.linspace(0, len(text), int(self.most[owner]) + 2).astype(int)
                for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                    # A piece of no character is unchanged anywhere: every place is one.
                    width = min(b - a, 8)
                    key = _grams(symbols[a : a + width], width) if width else np.zeros(1, np.uint32)
                    pieces.setdefault(width, []).append((key, np.array([owner]), np.array([a])))
                continue
            starts = np.arange(max(1, len(symbols) - plan.distinct + 1))
            symbols = np.append(symbols, np.zeros(plan.length, np.uint32))
            for rows, found in plan.keys(symbols, starts):
                walked.append((found, np.full(len(rows), owner), starts[rows]))
        self.walked = Seeds(walked) if walked else None
        self.pieces = {width: Seeds(parts) for width, parts in pieces.items()}

    def may_be_near(self, symbols: np.ndarray, item: np.ndarray, at: np.ndarray, most: int = 8192) -> np.ndarray:
        """Rows where an item may start within ``_NEAR`` of ``at``. The least edits of its parts,
        each near its own place, add up to no more than those of the whole; rows leave when
        the sum is above the bound."""
        classes = (symbols % _CLASSES).astype(np.int64)
        order = np.argsort(self.spans[item], kind="stable")
        kept = [np.zeros(0, dtype=np.int64)]
        for a in range(0, len(order), most):
            rows = order[a : a + most]
            sums = np.zeros(len(rows), dtype=np.int64)
            done = 0
            while len(rows) and done < self.parts[item[rows]].max():
                own = item[rows]
                live = np.flatnonzero(self.parts[own] > done)
                sums[live] += self._least(classes, own[live], at[rows[live]], done)
                stay = sums <= self.most[own]
                rows, sums = rows[stay], sums[stay]
                done += 1
            kept.append(rows)
        return np.sort(np.concatenate(kept))

    def _least(self, classes: np.ndarray, own: np.ndarray, at: np.ndarray, part: int) -> np.ndarray:
        """Least edits between a part of each item and the text about its place (Myers)."""
        spans, parts, slack = self.spans[own], self.parts[own], self.most[own]
        begin, end = -(-part * spans // parts), -(-(part + 1) * spans // parts)
        size = end - begin
        table, base = self.where.ravel(), (self.first[own] + part) * _CLASSES
        place = at + begin - slack
        one, top = np.uint64(1), (size - 1).astype(np.uint64)
        up, down = np.full(len(own), 2**64 - 1, dtype=np.uint64), np.zeros(len(own), dtype=np.uint64)
        edits, least = size.copy(), size.copy()
        # One set of arrays for all columns.
        symbol, match, diagonal, rise, fall, bit = (
            np.empty(len(own), dtype=kind) for kind in (np.int64, *[np.uint64] * 5)
        )
        for _ in range(int((size + 2 * slack).max()) + _NEAR):
            classes.take(place, mode="clip", out=symbol)
            place += 1
            symbol += base
            table.take(symbol, mode="clip", out=match)
            np.bitwise_and(match, up, out=diagonal)
            diagonal += up
            diagonal ^= up
            diagonal |= match
            diagonal |= down
            np.bitwise_or(diagonal, up, out=rise)
            np.invert(rise, out=rise)
            rise |= down
            np.bitwise_and(up, diagonal, out=fall)
            np.right_shift(rise, top, out=bit)
            bit &= one
            edits += bit.view(np.int64)
            np.right_shift(fall, top, out=bit)
            bit &= one
            edits -= bit.view(np.int64)
            np.minimum(least, edits, out=least)
            rise <<= one
            fall <<= one
            np.bitwise_or(diagonal, rise, out=up)
            np.invert(up, out=up)
            up |= fall
            np.bitwise_and(rise, diagonal, out=down)
        return least


def _judge(items, plan: Plan, step: int, similarity: float, short_chars: int) -> Callable:
    def run(batches):
        block = Items(items, plan, similarity, short_chars)
        far = int(block.spans.max(initial=0)) + _NEAR

        def judge(docs: list, texts: list[str]) -> list[tuple]:
            gap = "\0" * (plan.length + 2)
            # Each text stands between blanks, as short items are searched with theirs.
            symbols = _symbols("".join(f" {t} {gap}" for t in texts))
            sizes = np.array([len(t) for t in texts])
            begins = np.cumsum(sizes + len(gap) + 2) - (sizes + len(gap) + 2)
            buckets = (len(symbols) + far) // _NEAR + 1
            wanted: list = []

            def note(places: np.ndarray, owners: np.ndarray, offsets: np.ndarray) -> None:
                doc = np.searchsorted(begins, places, "right") - 1
                bucket = (places - offsets + far) // _NEAR
                wanted.append(np.unique((doc * len(block.ids) + owners) * buckets + bucket))

            if block.walked:
                starts = np.concatenate(
                    [np.arange(a + 1, a + 1 + max(1, n - plan.distinct + 1), step) for a, n in zip(begins, sizes)]
                )
                for rows, found in plan.keys(symbols, starts):
                    for row, owners, offsets in block.walked.hits(found):
                        note(starts[rows[row]], owners, offsets)
            for width, seeds in block.pieces.items():
                found = _grams(symbols, width) if width else np.zeros(len(symbols), np.uint32)
                for row, owners, offsets in seeds.hits(found):
                    note(row, owners, offsets)
            if not wanted:
                return []
            pairs, bucket = np.divmod(np.unique(np.concatenate(wanted)), buckets)
            doc, item = np.divmod(pairs, len(block.ids))
            at = bucket * _NEAR - far
            near = block.may_be_near(symbols, item, at)
            out: dict = {}
            for d, i, first in zip(doc[near].tolist(), item[near].tolist(), at[near].tolist()):
                old = out.get((d, i))
                if old is not None and old[0] == 0:
                    continue
                most, own, text = int(block.most[i]), block.plain[i], texts[d]
                short = bool(block.short[i])
                if short:
                    text = f" {text} "
                first -= int(begins[d]) + (not short)
                last = max(0, first + _NEAR + len(own) + most)
                first = max(0, first - most)
                part = text[first:last]
                edits, end = _aligned(own, part)
                if edits <= most and (old is None or edits < old[0]):
                    # Where it starts: the same alignment from the end.
                    start = first + end - _aligned(own[::-1], part[:end][::-1])[1]
                    out[d, i] = edits, max(0, text.count(" ", 0, start + short) - short)
            return [(docs[d], block.ids[i], e, int(block.sizes[i]), at) for (d, i), (e, at) in out.items()]

        columns = ["doc_id", "item_id", "edits", "item_chars", "word_start"]
        for batch in batches:
            found: list = []
            pairs = ((k, plain_text(letters(t))) for k, t in zip(batch["key"].tolist(), batch["text"].tolist()))
            for group in in_groups((p for p in pairs if p[1]), lambda p: len(p[1])):
                keys_, texts = zip(*group)
                found.extend(judge([None if pd.isna(k) else int(k) for k in keys_], list(texts)))
            yield pd.DataFrame(found, columns=columns).astype({"doc_id": "Int64", "item_id": "Int64"})

    return run


def item_blocks(items: DataFrame, key: str, text: str, item_block: int, block_chars: int):
    """Lists of (id, text) within both bounds, one block on the driver at a time."""
    block: list = []
    chars = 0
    pairs = items.where(F.col(text).isNotNull()).select(F.col(key).cast("long"), F.col(text))
    for row in pairs.toLocalIterator():
        if block and (len(block) >= item_block or chars + len(row[1]) > block_chars):
            yield block
            block, chars = [], 0
        block.append((row[0], row[1]))
        chars += len(row[1])
    if block:
        yield block


def leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
    walks: int = 2,
    bands: int = 4,
    sampled: int = 9,
    distinct: int = 8,
    length: int = 18,
    step: int = 4,
    short_chars: int = 80,
    item_block: int = 5_000,
    block_chars: int = 5_000_000,
    seed: int = 7,
) -> DataFrame:
    """doc_id, item_id, edits, item_chars and word_start of every leak."""
    spark = docs.sparkSession
    plan = Plan(walks, bands, sampled, length, distinct, seed)
    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    schema = "doc_id long, item_id long, edits int, item_chars int, word_start int"
    out = spark.createDataFrame([], schema)
    for block in item_blocks(items, item_key, item_text, item_block, block_chars):
        out = out.unionByName(pairs.mapInPandas(_judge(block, plan, step, similarity, short_chars), schema))
    return out


def without_leaks(docs: DataFrame, found: DataFrame, *, key: str = "doc_id") -> DataFrame:
    """The documents that hold no leak; null ids cannot be named and stay."""
    return docs.join(found.select(F.col("doc_id").alias(key)).distinct(), key, "left_anti").select(*docs.columns)
