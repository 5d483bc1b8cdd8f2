"""Recall of the leak search for typos and word edits at the threshold."""

import random

import pytest

from meterline.llm import cgk_windows

LETTERS = "abcdefghijklmnopqrstuvwxyz"
RATES = (0.05, 0.1, 0.15, 0.2)


def typos(text, rate, rng):
    out = list(text)
    for i in rng.sample(range(len(out)), int(rate * len(out))):
        out[i] = rng.choice(LETTERS)
    return "".join(out)


def mixed_edits(text, rate, rng):
    out = list(text)
    for i in rng.sample(range(len(out)), int(rate * len(out))):
        out[i] = rng.choice(["", rng.choice(LETTERS), out[i] + rng.choice(LETTERS)])
    return "".join(out)


def other_words(text, rate, rng):
    own, left = text.split(), int(rate * len(text))
    for i in rng.sample(range(len(own)), len(own)):
        if len(own[i]) <= left:
            left -= len(own[i])
            own[i] = "".join(rng.choices(LETTERS, k=len(own[i])))
    return " ".join(own)


def prose(rng):
    words = ["".join(rng.choices(LETTERS, k=rng.randint(2, 10))) for _ in range(4000)]
    return lambda n: " ".join(rng.choices(words, k=n))


def found(spark, docs, items):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in cgk_windows.leaks(df, bench).collect()}


@pytest.mark.parametrize("edit", (typos, mixed_edits, other_words))
def test_recall_at_the_threshold(spark, edit):
    rng = random.Random(11)
    text = prose(rng)
    items = [(i, text(n)) for i, n in enumerate([*range(15, 25)] * 6 + [*range(25, 65)])]
    docs = [
        (1000 * k + i, f"{text(40)} {edit(t, rate, rng)} {text(30)}")
        for k, rate in enumerate(RATES)
        for i, t in items
    ]
    got = found(spark, docs, items)
    for k, rate in enumerate(RATES):
        for low, high in ((0, 60), (60, 100)):
            share = sum((1000 * k + i, i) in got for i in range(low, high)) / (high - low)
            print(edit.__name__, rate, "short" if low == 0 else "long", f"{share:.3f}")
            assert share >= 0.95
    assert all(d % 1000 == i for d, i in got)
