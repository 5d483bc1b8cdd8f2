"""Items of few words are found with edits, and only as words."""

import random

from tests.llm.test_leak_recall import RATES, found, mixed_edits, prose, typos


def test_short_items_are_found_with_edits(spark):
    rng = random.Random(12)
    text = prose(rng)
    items = [(n, text(n)) for n in range(3, 15)]
    docs = [
        (1000 * k + 100 * (j + 1) + i, f"{text(30)} {edit(t, rate, rng)} {text(9)}")
        for k, rate in enumerate(RATES)
        for j, edit in enumerate((typos, mixed_edits))
        for i, t in items
    ]
    docs += [(9000 + i, f"{text(7)} {t}s {text(5)}") for i, t in items] + [(8000, text(500))]
    got = found(spark, docs, items)
    assert {d for d, _ in docs} - {d for d, i in got if d % 100 == i} == {8000}
    assert all(got[9000 + i, i].word_start == 7 and got[9000 + i, i].edits <= 1 for i, _ in items)


def test_short_items_stand_as_words(spark):
    items = [(1, "cat"), (2, "is it so"), (3, "a")]
    docs = [(1, "The cat."), (2, "concatenate"), (3, "well is, it so"), (4, "well iss it so"), (5, "this it sort")]
    assert set(found(spark, docs, items)) == {(1, 1), (3, 2), (4, 2)}
