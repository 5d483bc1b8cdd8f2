"""Words of texts of few code points are those of the vocabulary's pattern."""

import itertools
import random

import numpy as np
import regex

from meterline.llm.token_shards import PATTERN, Encoder

WORDS = regex.compile(PATTERN).findall


def test_latin_texts_take_the_faster_pattern_and_give_the_same_words():
    encode = Encoder()
    called = []
    encode._words = lambda text: called.append(text) or WORDS(text)
    latin = [chr(i) for i in range(256)]
    texts = [a + b for a, b in itertools.product(latin, latin)]
    draw = random.Random(1)
    texts += ["".join(draw.choices(latin, k=40)) for _ in range(5_000)]
    texts += ["".join(draw.choices("a'slvdé1² \n\t\x85\xa0.,", k=30)) for _ in range(5_000)]
    assert all(encode.words(text) == WORDS(text) for text in texts)
    assert called == []
    assert encode.words("naïve “text”") == WORDS("naïve “text”")
    assert called == ["naïve “text”"]


def test_ids_are_those_of_the_library():
    encode = Encoder(limit=50)
    draw = random.Random(2)
    for _ in range(500):
        text = "".join(draw.choices("ab'sé1² \n\xa0.—日🙂", k=draw.randrange(60)))
        ids = encode._encoding.encode_ordinary(text)
        assert np.frombuffer(encode(text), dtype="<u2").tolist() == ids
