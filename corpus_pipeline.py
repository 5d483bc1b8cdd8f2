"""A training corpus from the documents table, stage by stage.

Each stage works on all its predecessor kept and returns the columns of ``documents``; the
last one returns the records of the written token shards. Languages come first, so that
texts without any language never reach the joins; near copies go before benchmark
passages are searched; the mix is taken from what is left and repeats documents where
their source is short; the tokens follow the mix.

Defined results: rows are documents of their own, also those of null or equal ids. Null and
empty texts have no language and leave in the first stage. Of equal texts one stays, that of the smallest id
(null last, then the place in its file). Very long texts are read as a whole in every
stage. An empty table gives no record. Columns beside ``doc_id``, ``text``, ``lang`` and
``source`` are passed on; ``_row``, ``_file`` and ``_place`` are no names for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterline.llm import cgk_windows, crf_langid, mixing, signature_trees, token_shards
from meterline.llm.common import numbered, table
from meterline.session import new_folder

#: Rows are told apart by a number of their own, as ids can be null or repeated.
ROW = "_row"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps texts with a language: not ``und``, and one language has half of all words.

    The model learns from a bounded sample of the documents' own ``lang`` column.
    """
    model = crf_langid.train(docs)
    return crf_langid.keep_languages(docs, model, least=0.5).select(*docs.columns)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    rows = numbered(docs)
    groups = signature_trees.jaccard_components(rows, width=5, num=80, den=100, key=ROW)
    return signature_trees.one_of_each(rows, groups, row=ROW).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    rows = numbered(docs)
    found = cgk_windows.leaks(rows, table(spark, sf_dir, "benchmark"), key=ROW)
    return cgk_windows.without_leaks(rows, found, key=ROW).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them."""
    return mixing.mix_rows(docs, mixing.mix(docs)).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The records of the shards, in training order: slot, shard, offset, document, digest."""
    return token_shards.read_records(token_shards.write_shards(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("jaccard_join", jaccard_join),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_output", token_output),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{i}-{name}")
    return docs


#: The CRF and the edit alignments cannot be written in SQL; tests compare with brute force.
ORACLE_SQL = None
