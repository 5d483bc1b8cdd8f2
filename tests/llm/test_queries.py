"""The queries beside their SQL, and the pipeline's stages."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm.oracles import ORACLES
from meterline.llm.queries import QUERIES
from meterline_checks.compare import connect

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con: duckdb.DuckDBPyConnection = connect(SMALL)
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    ours = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    picked = ", ".join(f'"{c}"' for c in columns)
    theirs = sorted(con.execute(f"SELECT {picked} FROM ({ORACLES[name]})").fetchall(), key=repr)
    assert ours == theirs


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op4_crf_language"](spark, SMALL).join(docs, "doc_id").where("held_out")
    right = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.9


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        kept = out.select("doc_id").distinct()
        assert kept.join(docs, "doc_id", "left_anti").isEmpty()
        docs = spark.createDataFrame(out.collect(), docs.schema)
    tokens = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL)
    assert tokens.select("slot").distinct().count() == tokens.count() > 0
