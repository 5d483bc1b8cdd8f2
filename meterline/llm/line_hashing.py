"""Substring dedup by hashing lines and the sentences in them.

A text is cut at line ends and after ``.``, ``!`` or ``?`` followed by a blank, so that a
repeated passage is found also where other words stand before and behind it on its line.
Units of at least ``min_words`` words are normalised (lower case, single blanks) and
digested to 128 bits; digests are counted globally; of each the first occurrence, by
document id and offset, stays and the others are removed with their offsets kept.

Defined results (of both ways to cut): offsets count characters of the original text, end exclusive. Null and
empty texts have no units. Rows with a null id come last in rank. Rows with equal ids and
equal offsets are one occurrence, so repeated rows do not remove each other. Only the id
and the text are read from the documents, so other columns may have any name. An empty
table has no units; very long texts are cut whole.

``passage_units`` cuts so that every word lies in a unit: whole paragraphs (between blank
lines), whole lines of any length, and sentences, short ones with the next of their line (at
its end the last before) until there are enough words. Spans of these overlap and are
merged on removal. What is removed stands at an earlier place too, so the earliest copy
of every text stays.
"""

from __future__ import annotations

import re

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.session import stored

_BLANKS = re.compile(r"[ \t\r\x0b\x0c]+")


def text_units(text: str, min_words: int) -> list[tuple[int, int, str]]:
    """(start, end, normalised text) of the units with enough words."""
    out = []
    start, size = 0, len(text)
    for line in text.split("\n"):
        at = start
        for piece in re.split(r"(?<=[.!?]) ", line):
            plain = " ".join(w for w in _BLANKS.split(piece.lower()) if w)
            if plain.count(" ") + 1 >= min_words:
                out.append((at, at + len(piece), plain))
            at += len(piece) + 1
        start += len(line) + 1
    assert start == size + 1
    return out


def _plain(text: str) -> bytes:
    """Lower case, single blanks; bytes split at the six ASCII white-space characters."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").split())


def passage_units(text: str, min_words: int) -> list[tuple[int, int, str]]:
    """(start, end, normalised text) of paragraphs, lines and sentences; every word is in one."""
    return [(a, b, plain.decode("utf-8", "surrogatepass")) for a, b, plain in passage_spans(text, min_words)]


def passage_spans(text: str, min_words: int) -> list[tuple[int, int, bytes]]:
    """As ``passage_units``, with the normalised text as the bytes that are digested."""
    spans: dict[tuple[int, int], bytes] = {}
    start, opened, closed = 0, 0, 0
    paragraph: list[bytes] = []

    def close() -> None:
        if paragraph:
            spans[opened, closed] = b" ".join(paragraph)
            paragraph.clear()

    for line in text.split("\n"):
        end = start + len(line)
        ends, plains, counts = [], [], []
        at = start
        for piece in re.split(r"(?<=[.!?]) ", line):
            plain = _plain(piece)
            at += len(piece) + 1
            ends.append(at - 1)
            plains.append(plain)
            counts.append(plain.count(b" ") + 1 if plain else 0)
        whole = b" ".join(p for p in plains if p)
        if not whole:
            close()
            start = end + 1
            continue
        opened, closed = (opened if paragraph else start), end
        paragraph.append(whole)
        spans[start, end] = whole
        begins = [start, *(e + 1 for e in ends[:-1])]
        for i, words in enumerate(counts):
            first = last = i
            while words < min_words and last + 1 < len(counts):
                last += 1
                words += counts[last]
            while words < min_words and first > 0:
                first -= 1
                words += counts[first]
            span = begins[first], ends[last]
            if words >= min_words and span not in spans:
                spans[span] = b" ".join(p for p in plains[first : last + 1] if p)
        start = end + 1
    close()
    return [(a, b, plain) for (a, b), plain in sorted(spans.items())]


def units(
    docs: DataFrame, min_words: int, key: str = "doc_id", text: str = "text", cut=text_units
) -> DataFrame:
    """doc_id, unit_start, unit_end and digest of every unit that ``cut`` makes."""

    def run(batches):
        digest = xxhash.xxh3_128_digest
        for batch in batches:
            rows: list = []
            for doc, body in zip(batch["key"].tolist(), batch["text"].tolist()):
                if isinstance(body, str) and body:
                    doc = None if pd.isna(doc) else int(doc)
                    rows.extend(
                        (doc, a, b, digest(unit if isinstance(unit, bytes) else unit.encode("utf-8", "surrogatepass")))
                        for a, b, unit in cut(body, min_words)
                    )
                if len(rows) >= 50_000:
                    yield _frame(rows)
                    rows = []
            yield _frame(rows)

    pairs = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return pairs.mapInPandas(run, "doc_id long, unit_start int, unit_end int, digest binary")


def _frame(rows: list) -> pd.DataFrame:
    columns = ["doc_id", "unit_start", "unit_end", "digest"]
    return pd.DataFrame(rows, columns=columns).astype(
        {"doc_id": "Int64", "unit_start": "int32", "unit_end": "int32"}
    )


def repeated_units(
    docs: DataFrame, *, min_words: int = 8, key: str = "doc_id", text: str = "text", cut=text_units
) -> DataFrame:
    """Every occurrence to remove: doc_id, its span, and the document and offset that stay.

    Units are made once and stored as digests and spans. Digests that occur once leave at
    the first aggregation, and a digest of very many occurrences is one row there. What is
    left is stored too, so that the join back is a plain one of two stored frames, in which
    adaptive execution splits the partition of a hot digest.
    """
    found = stored(units(docs, min_words, key, text, cut), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "unit_start")
    first = (
        found.groupBy("digest")
        .agg(F.min(rank).alias("first"), F.max(rank).alias("latest"))
        .where("not (first <=> latest)")
        .select("digest", "first")
    )
    first = stored(first, "repeated_digests")
    return (
        found.join(first, "digest")
        .where("not (doc_id <=> first.doc_id and unit_start = first.unit_start)")
        .select(
            F.col("doc_id").alias(key),
            "unit_start",
            "unit_end",
            F.col("first.doc_id").alias("kept_doc_id"),
            F.col("first.unit_start").alias("kept_start"),
        )
    )


def without_units(docs: DataFrame, removed: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with the spans of ``removed`` cut from their texts (distinct keys)."""
    spans = removed.groupBy(F.col(key).alias("_cut_key")).agg(
        F.sort_array(F.collect_set(F.struct("unit_start", "unit_end"))).alias("_cut_spans")
    )

    @F.pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for body, cuts in zip(texts, spans):
            if body is not None and cuts is not None:
                parts, at = [], 0
                for c in cuts:
                    parts.append(body[at : c["unit_start"]])
                    at = max(at, c["unit_end"])
                body = "".join([*parts, body[at:]])
            out.append(body)
        return pd.Series(out, dtype=object)

    joined = docs.join(spans, docs[key].eqNullSafe(F.col("_cut_key")), "left")
    return joined.select(
        *[cut(docs[text], F.col("_cut_spans")).alias(text) if c == text else docs[c] for c in docs.columns]
    )
