"""Rows of null and repeated ids in the stages of the pipeline; its edge cases; the language sample."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import cgk_windows, crf_langid, mixing, signature_trees
from meterline.llm.common import numbered

DOCS = "doc_id long, text string, lang string, source string, n_chars int, key string, size long"
A = "one two three four five six seven eight nine ten eleven twelve thirteen"
B = "red orange yellow green blue indigo violet black white grey brown pink gold"
C = "der die das und nicht mit von wir sie es ist ein kein sehr gut"


def docs(spark, *rows):
    """Rows of id, text and perhaps [lang, source]."""
    full = [(row[0], row[1], *(row[2] if len(row) > 2 else ("en", "s")), 0, "k", 1) for row in rows]
    return spark.createDataFrame(full, DOCS)


def ids_and_texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


@pytest.mark.parametrize("stored_first", [True, False])
def test_every_group_keeps_one(spark, tmp_path, stored_first):
    df = docs(spark, (5, A), (7, A), (5, B), (3, B), (None, A), (None, C), (None, C))
    if stored_first:
        df.repartition(3).write.parquet(str(tmp_path / "docs"))
        df = spark.read.parquet(str(tmp_path / "docs"))
    rows = numbered(df)
    assert rows.select("_row").distinct().count() == 7
    groups = signature_trees.jaccard_components(rows, key="_row")
    kept = signature_trees.one_of_each(rows, groups, row="_row")
    assert ids_and_texts(kept) == sorted([(5, A), (3, B), (None, C)], key=repr)


def test_leaks_of_null_ids_leave(spark):
    item = "the quick brown fox jumps over the lazy dog and then it runs away into the deep dark wood again"
    df = docs(spark, (None, f"{A} {item} {B}"), (None, A), (2, item), (2, B))
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = numbered(df)
    found = cgk_windows.leaks(rows, items, key="_row")
    kept = cgk_windows.without_leaks(rows, found, key="_row")
    assert ids_and_texts(kept) == sorted([(None, A), (2, B)], key=repr)


def test_mixed_rows_come_as_often_as_taken(spark):
    rows = [(None, A), (None, A), (4, B), (4, B), (4, ""), (4, None), *[(100 + i, A) for i in range(40)]]
    df = docs(spark, *rows)
    more = docs(spark, *[(i, f"{B} {i}") for i in range(60)]).withColumn("source", F.lit("t"))
    both = df.unionByName(more)
    mixed = mixing.mix(both)
    got = mixing.mix_rows(both, mixed)
    assert got.columns == both.columns
    taken = mixed.where("size > 0").agg({"times": "sum"}).first()[0]
    assert got.count() == taken + 2  # the two without words stay once
    words = got.select(mixing.word_count(got["text"]).alias("w")).agg({"w": "sum"}).first()[0]
    assert words == mixed.agg({"taken": "sum"}).first()[0]


def test_stages_on_edge_cases(spark, tmp_path):
    long = " ".join(f"{w} {i}" for i in range(3_000) for w in ("the", "house", "is", "red"))
    rows = [(1, None), (2, ""), (3, " \n"), (None, A), (None, A), (6, long), (6, B), (6, B), (8, "?!")]
    rows += [(20 + i, f"{C} nummer {i} und {i * i}", ["de", "t"]) for i in range(12)]
    rows += [(40 + i, f"the weather of day {i} was fine and {i * 7} people went out to the sea") for i in range(12)]
    df = docs(spark, *rows)
    folder = str(tmp_path)
    df.write.parquet(f"{folder}/documents.parquet")
    items = spark.createDataFrame([(1, "nothing of this stands in any of these documents at all, not one clause")], "item_id long, text string")
    items.write.parquet(f"{folder}/benchmark.parquet")
    kept = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, kept, folder)
        assert out.columns == df.columns, name
        out.write.parquet(f"{folder}/{name}")
        kept = spark.read.parquet(f"{folder}/{name}")
    left = kept.collect()
    assert not {1, 2, 3, 8} & {r.doc_id for r in left}
    assert [r.text for r in left].count(A) == 1 and [r.text for r in left].count(B) == 1
    assert long in {r.text for r in left}
    tokens = corpus_pipeline.run(spark, folder)
    assert tokens.select("slot").distinct().count() == tokens.count() > 0

    empty = str(tmp_path / "empty")
    df.limit(0).write.parquet(f"{empty}/documents.parquet")
    items.write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_every_label_is_learned(spark):
    rows = [(i, f"word{i % 70} and so on {i}", f"l{i % 70}", "s") for i in range(700)]
    rows += [(None, "no id", "l0", "s")] * 5
    df = spark.createDataFrame([(*r, 0, "k", 1) for r in rows], DOCS)
    how = {"text": "text", "lang": "lang", "key": "doc_id", "most_chars": 1000}
    texts, langs = crf_langid.labelled_sample(df, per_label=4, most_texts=10_000, **how)
    assert len(set(langs)) == 70 and all(langs.count(f"l{i}") == 4 for i in range(70))
    again = crf_langid.labelled_sample(df.repartition(5), per_label=4, most_texts=10_000, **how)
    assert again == (texts, langs)
    _, few = crf_langid.labelled_sample(df, per_label=4, most_texts=30, **how)
    assert sorted(few) == sorted(f"l{i}" for i in range(70))
    assert crf_langid.labelled_sample(df.limit(0), per_label=4, most_texts=30, **how) == ([], [])
