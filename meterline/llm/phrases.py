"""Phrases that stand together more often than their parts: counts by prefix-free parsing.

Texts are cut into pieces at punctuation and line ends, pieces into words. A piece is
parsed into chunks: where a window of ``longest - 1`` words has a hash that ``period``
divides, a chunk ends with the window and the next one begins with it, so equal passages
are cut alike wherever they stand. Chunks overlap by that window, and a phrase of up to
``longest`` words lies wholly in the chunk that owns its first word: every chunk owns its
words but the last window, the last chunk of a piece all of them. So an overlap is counted
once. The distinct chunks with their frequencies are the dictionary; phrases are counted
inside distinct chunks, weighted by frequency.

Longer phrases are counted only where all their pairs of words can be frequent, pairs only
where both words can. A bitmap of at most ``2 ** MOST_BITS`` bits (16 MB), filled from the
hashes of what was found frequent, tells so; it can be wrong only by letting more through,
and the counts themselves are sums over exact texts. Tasks sum before each shuffle.

Defined results: a null language is ``und``, a null text empty, and a text without words
has no phrase. Repeated rows count each. Ties are settled by the order of the result. Very
long texts and pieces are counted whole. Only the language and the text are read, so other
columns may have any name. An empty table gives no phrase.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import in_groups, mixed, word_hashes
from meterline.session import stored

#: Lower-cases A-Z, makes tabs blanks and the signs that end a piece line feeds.
_PLAIN = bytes(
    10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c + 32 if 65 <= c <= 90 else c for c in range(256)
)
_BLANKS = re.compile(rb" {2,}")
#: Distinct chunks of a task, and words of a group of chunks, that are held at a time.
HELD_CHUNKS = 300_000
HELD_WORDS = 2_000_000
MOST_BITS = 27
BLOCK_BITS = 13
CHUNKS = "lang string, chunk binary, last boolean, freq long"
COUNTS = "lang string, phrase string, f long"


def chunks_of(texts: list[str], window: int, period: int) -> tuple[list[bytes], list[bytes]]:
    """The chunks of all pieces of the texts: those with a chunk after them, and last ones."""
    plain = [_BLANKS.sub(b" ", t.encode("utf-8", "surrogatepass").translate(_PLAIN)) for t in texts]
    signs = b"\n".join(plain)
    hashes, _, starts, joined = word_hashes([signs.replace(b"\n", b" ")])
    if not len(starts):
        return [], []
    # ``joined`` has a blank before the text, so places are one further than in ``signs``.
    a = np.frombuffer(signs, dtype=np.uint8)
    piece = np.cumsum(a == 10)[starts - 1]
    blank = np.frombuffer(joined, dtype=np.uint8) == 32
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    first = np.diff(piece, prepend=-1) != 0
    cut = first.copy()
    n = len(starts) - window + 1
    if n > 0:
        mark = np.zeros(n, dtype=np.uint64)
        for i in range(window):
            mark = mixed(mark * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n + i])
        cut[:n] |= (mark % np.uint64(period) == 0) & (piece[:n] == piece[window - 1 :])
    begins = np.flatnonzero(cut)
    following = np.append(begins[1:], len(starts))
    last = np.append(first[begins[1:]], True)
    stops = ends[np.where(last, following, following + window) - 1]
    slices = [joined[i:j] for i, j in zip(starts[begins].tolist(), stops.tolist())]
    return [s for s, done in zip(slices, last.tolist()) if not done], [s for s, done in zip(slices, last.tolist()) if done]


def _parse(window: int, period: int) -> Callable:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[tuple[str, bool], Counter] = defaultdict(Counter)

        def rows() -> Iterator[pd.DataFrame]:
            for (lang, flag), counts in found.items():
                yield pd.DataFrame(
                    {
                        "lang": lang,
                        "chunk": pd.Series(list(counts), dtype=object),
                        "last": flag,
                        "freq": np.fromiter(counts.values(), dtype=np.int64, count=len(counts)),
                    }
                )
            found.clear()

        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for group in in_groups(texts.tolist(), len, 1 << 20):
                    inner, last = chunks_of(group, window, period)
                    found[lang, False].update(inner)
                    found[lang, True].update(last)
                    if sum(map(len, found.values())) > HELD_CHUNKS:
                        yield from rows()
        yield from rows()

    return run


def dictionary(docs: DataFrame, window: int, period: int) -> DataFrame:
    """(lang, chunk, last, freq): the distinct chunks of all texts and how often they occur."""
    texts = docs.select(
        F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    parts = texts.mapInPandas(_parse(window, period), CHUNKS)
    parts = parts.withColumn("chunk", F.col("chunk").cast("string"))
    return stored(parts.groupBy("lang", "chunk", "last").agg(F.sum("freq").alias("freq")), "chunks")


class Frequent:
    """A bitmap of hashes; what it denies is not frequent."""

    def __init__(self, bits: int, blocks: dict[int, bytes]):
        self._mask = (1 << bits) - 1
        data = np.zeros((1 << bits) // 8, dtype=np.uint8)
        size = (1 << BLOCK_BITS) // 8
        for block, part in blocks.items():
            data[block * size : (block + 1) * size] = np.frombuffer(part, dtype=np.uint8)
        self._data = data

    def __call__(self, lang: str, phrases) -> np.ndarray:
        start = zlib.crc32(f"{lang}\0".encode())
        slots = np.fromiter((zlib.crc32(p.encode(), start) for p in phrases), dtype=np.int64) & self._mask
        return (self._data[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _block_bits(key: tuple, slots: pd.DataFrame) -> pd.DataFrame:
    held = np.zeros(1 << BLOCK_BITS, dtype=np.uint8)
    held[slots["slot"].to_numpy() & ((1 << BLOCK_BITS) - 1)] = 1
    return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(held, bitorder="little").tobytes()]})


def bitmap(frequent: DataFrame) -> Frequent:
    """The bitmap of ``frequent`` (lang, phrase): 16 bits each, 16 MB at most."""
    bits = min(MOST_BITS, max(BLOCK_BITS, (16 * frequent.count()).bit_length()))
    slot = F.crc32(F.concat("lang", F.lit("\0"), "phrase")).bitwiseAND((1 << bits) - 1)
    slots = frequent.select(slot.alias("slot")).distinct()
    blocks = slots.groupBy(F.shiftright("slot", BLOCK_BITS).alias("block")).applyInPandas(_block_bits, "block long, bits binary")
    return Frequent(bits, {row.block: bytes(row.bits) for row in blocks.collect()})


def _weighted(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the whole-number sums of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    begins = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
    return keys[begins], np.add.reduceat(weights[order], begins)


def count_group(
    lang: str,
    chunks: list[str],
    last: np.ndarray,
    freq: np.ndarray,
    window: int,
    words_ok: Frequent,
    pairs_ok: Frequent | None,
) -> pd.DataFrame:
    """Weighted counts of the phrases in distinct chunks: pairs, or with ``pairs_ok`` longer ones."""
    lengths = np.array([c.count(" ") + 1 for c in chunks])
    codes, names = pd.factorize(np.array(" ".join(chunks).split(" "), dtype=object))
    number = np.repeat(np.arange(len(chunks)), lengths)
    end = np.cumsum(lengths)[number]
    owned = np.arange(len(codes)) < end - np.where(last, 0, window)[number]
    weight = freq[number]
    fine = words_ok(lang, names)[codes]
    follows = np.arange(1, len(codes) + 1) < end  # a word of the same chunk comes next
    pair = np.flatnonzero(follows[:-1] & fine[:-1] & fine[1:])
    if not len(pair):
        return _counts(lang, [])
    two, pair_names = pd.factorize(codes[pair] * len(names) + codes[pair + 1])
    pair_names = names[pair_names // len(names)] + " " + names[pair_names % len(names)]
    out: list[tuple[np.ndarray, np.ndarray]] = []

    def add(place: np.ndarray, phrase: np.ndarray, texts: np.ndarray) -> None:
        mine = owned[place]
        if mine.any():
            found, sums = _weighted(phrase[mine], weight[place[mine]])
            out.append((texts[found], sums))

    if pairs_ok is None:
        add(pair, two, pair_names)
    else:
        known = pairs_ok(lang, pair_names)[two]
        place, phrase, texts = pair[known], two[known], pair_names
        good = np.zeros(len(codes) + 1, dtype=bool)
        good[place] = True
        for size in range(3, window + 2):
            on = good[place + size - 2]
            place, before = place[on], phrase[on]
            if not len(place):
                break
            phrase, longer = pd.factorize(before * len(names) + codes[place + size - 1])
            texts = texts[longer // len(names)] + " " + names[longer % len(names)]
            add(place, phrase, texts)
    return _counts(lang, out)


def _counts(lang: str, parts: list[tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    phrases = np.concatenate([p for p, _ in parts] or [np.zeros(0, dtype=object)])
    sums = np.concatenate([f for _, f in parts] or [np.zeros(0, dtype=np.int64)])
    return pd.DataFrame({"lang": pd.Series([lang] * len(sums), dtype=object), "phrase": pd.Series(phrases, dtype=object), "f": sums})


def count_phrases(chunks: DataFrame, window: int, words_ok, pairs_ok=None) -> DataFrame:
    """(lang, phrase, f): phrases of two words, or with ``pairs_ok`` of three and more.

    ``words_ok`` and ``pairs_ok`` are broadcast bitmaps. Counts are whole for all phrases
    whose words, and pairs of words, are frequent.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, words = [], 0

        def counted() -> Iterator[pd.DataFrame]:
            for lang, part in pd.concat(held).groupby("lang"):
                yield count_group(
                    lang, part["chunk"].tolist(), part["last"].to_numpy(), part["freq"].to_numpy(), window,
                    words_ok.value, pairs_ok.value if pairs_ok is not None else None,
                )

        for batch in batches:
            held.append(batch)
            words += int(batch["chunk"].str.count(" ").sum()) + len(batch)
            if words > HELD_WORDS:
                yield from counted()
                held, words = [], 0
        if held:
            yield from counted()

    parts = chunks.mapInPandas(run, COUNTS)
    return parts.groupBy("lang", "phrase").agg(F.sum("f").alias("f"))


def _whole(value: Column | str | int) -> Column:
    """A whole number with room for products of two counts."""
    column = F.lit(value) if isinstance(value, int) else F.col(value) if isinstance(value, str) else value
    return column.cast("decimal(19,0)")


def _run_of(words: str, start: int | Column, length: int | Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def mine(
    docs: DataFrame,
    *,
    longest: int = 4,
    least: int = 30,
    cover: int = 80,
    scale: int = 2_000_000,
    top: int = 2000,
    period: int = 24,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``a`` is the count of a phrase of 2 to ``longest`` words, ``least`` at least. Of its
    cuts into two parts with counts ``l`` and ``r`` the one with the smallest score
    ``floor(scale * a / (l + r))`` holds, the first of equal ones. A phrase within a longer
    one that has at least ``cover`` percent of its count is left out. ``n`` counts all
    words of the language.
    """
    window = longest - 1
    context = docs.sparkSession.sparkContext
    chunks = dictionary(docs, window, period)
    words = F.split("chunk", " ")
    owned = F.when(F.col("last"), words).otherwise(F.slice(words, F.lit(1), F.size(words) - window))
    counted = chunks.select("lang", "freq", F.explode(owned).alias("phrase"))
    single = counted.groupBy("lang", "phrase").agg(F.sum("freq").alias("f")).where(F.col("f") >= least)
    single = stored(single, "frequent_words")
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("freq") * F.size(owned)).alias("n"))
    words_ok = context.broadcast(bitmap(single))
    pairs = stored(count_phrases(chunks, window, words_ok).where(F.col("f") >= least), "frequent_pairs")
    found = pairs
    if longest > 2:
        pairs_ok = context.broadcast(bitmap(pairs))
        longer = count_phrases(chunks, window, words_ok, pairs_ok).where(F.col("f") >= least)
        found = stored(pairs.unionByName(longer), "frequent_phrases")
    return _best(single, found, sizes, cover, scale, top)


def _best(single: DataFrame, found: DataFrame, sizes: DataFrame, cover: int, scale: int, top: int) -> DataFrame:
    parts = single.unionByName(found)
    phrases = found.withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " "))
    cuts = phrases.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        _run_of("words", 1, F.col("k")).alias("left"),
        _run_of("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    cuts = cuts.withColumns({"_product": _whole(scale) * _whole("a"), "_sum": _whole("l") + _whole("r")})
    cuts = cuts.withColumn("score", F.expr("_product div _sum"))
    least = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(least).select("lang", "phrase", "a", "cut.*")

    # The runs of two words and more inside each longer phrase, with its count.
    length = F.size("words")
    runs = F.flatten(
        F.transform(
            F.sequence(F.lit(2), length - 1),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.size("words") - n + 1), lambda at: F.array_join(F.slice("words", at, n), " ")
            ),
        )
    )
    inside = phrases.where(length > 2).select("lang", F.explode(runs).alias("phrase"), "a")
    inside = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    covered = F.coalesce(_whole(100) * _whole("most") >= _whole(cover) * _whole("a"), F.lit(False))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(~covered)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
