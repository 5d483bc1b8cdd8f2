"""Repeated lines whose neighbours do not repeat with them."""

import random

from meterline.llm import suffix_runs
from meterline.llm.queries import QUERIES
from tests.llm.test_operators import brute_runs, rows


def test_single_lines_are_runs(spark, tmp_path):
    random.seed(8)
    passage = " ".join(f"word{i}" for i in range(60))
    docs = [(i, "\n".join(random.choices(["a", "b", "", "c ", f"u{i}"], k=random.randint(0, 12)))) for i in range(40)]
    docs += [(50, f"x\n{passage}\ny"), (51, f"p\n\n{passage}\nq"), (52, passage)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op7_all_repeated_lines"](spark, str(tmp_path))
    assert rows(got) == brute_runs(docs, 1)
    assert {(51, 2, 2, 1), (52, 0, 0, 1)} <= set(rows(got))
    left = {r.doc_id: r.text for r in suffix_runs.without_runs(df, got).collect()}
    assert (left[50], left[51], left[52]) == (f"x\n{passage}\ny", "p\n\nq", "")
