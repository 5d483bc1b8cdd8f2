"""Every word of a text lies in a unit, and repeated passages of short sentences go."""

from meterline.llm import line_hashing
from meterline.llm.queries import QUERIES
from tests.llm.test_operators import rows

SHORT = "One two three four five six seven. Eight nine."
LONG = " ".join(f"This is part {i} of it." for i in range(12))


def test_every_word_lies_in_a_unit():
    text = f"A b.\n\n{SHORT} \nx. y! {LONG}\n \n\ttail"
    covered = set()
    for a, b, plain in line_hashing.passage_units(text, 8):
        assert " ".join(text[a:b].lower().split()) == plain
        covered.update(range(a, b))
    assert all(text[i].isspace() for i in range(len(text)) if i not in covered)


def test_short_sentences_leave_with_their_passage(spark, tmp_path):
    docs = [
        (1, f"own words\n{SHORT}\nmore of it"),
        (2, f"{SHORT}"),
        (3, f"first\n{LONG}\nlast"),
        (4, f"Other words come before. {LONG} And others after it."),
        (5, "ab\nown words\ncd"),
        (6, "l one\nl two\n\nrest"),
        (7, "L one l  two"),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op3_passage_hashing"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "unit_start", "unit_end", "kept_doc_id", "kept_start"]
    assert rows(line_hashing.without_units(df, got)) == [
        docs[0],
        (2, ""),
        docs[2],
        (4, "Other words come before.  And others after it."),
        (5, "ab\n\ncd"),
        docs[5],
        (7, ""),
    ]


def test_edges(spark):
    kind = "doc_id long, text string, digest int, first int, unit_start int"
    long = "\n".join(f"line {i % 300} of a very long text" for i in range(20_000))
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, LONG), (4, LONG), (5, LONG), (None, LONG), (6, long)]
    df = spark.createDataFrame([(*d, 1, 2, 3) for d in docs], kind)
    got = line_hashing.repeated_units(df, cut=line_hashing.passage_spans)
    by_doc = {}
    for r in got.collect():
        by_doc.setdefault(r.doc_id, []).append(r)
    # Equal ids and offsets are one occurrence, a null id is the last in rank.
    assert set(by_doc) == {5, 6, None}
    assert all(r.kept_doc_id == 4 for r in by_doc[5] + by_doc[None])
    assert len({r.unit_start for r in by_doc[6]}) == 20_000 - 300
    assert line_hashing.repeated_units(df.limit(0), cut=line_hashing.passage_spans).collect() == []
