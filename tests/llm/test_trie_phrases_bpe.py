"""Conversation trie, phrase mining and byte-level BPE beside brute force; edge cases of each."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from meterline.llm import byte_bpe, phrases, prefix_trie
from meterline.llm.queries import QUERIES, fold

CONV = "conv_id long, turn long, role string, text string, key string, pos int, item int, path string"
DOCS = "doc_id long, text string, lang string, ids string, chunk string, f int, phrase int"


# Conversation prefix trie


def brute_trie(rows):
    """The query's rows from plain lists."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, mark), (role, text)))
    own = {c: [t for _, t in sorted(v, key=lambda x: x[0])] for c, v in own.items()}
    rebuilt = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(own.get(c - int(math.fmod(c, 5)), [])[:h] + seq[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sorted(rebuilt.items()):
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, those in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += kids[node] == 0
            saved[node[:d]] += (len(those) - 1) * (len(node[-1][1].encode()) if node else 0)
    return sorted(
        (
            m[0], len(n), members[n[:-1]][0] if n else None, len(m), kids[n], leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def trie_rows(spark, rows, height):
    table = spark.createDataFrame([(*r, "k", 1, 2, "p") for r in rows], CONV)
    seq, convs = prefix_trie.grafted(
        prefix_trie.turns(table), F.col("conv_id") - F.col("conv_id") % 5, fold("conv_id", 9), most=8
    )
    out = prefix_trie.trie(seq, convs, height)
    assert out.columns == "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return sorted((tuple(r) for r in out.collect()), key=lambda r: tuple(x is not None and x or 0 for x in r))


def same_rows(got, want):
    assert sorted(got, key=repr) == sorted(want, key=repr)


def talk(rng, conv, n, words="ab"):
    return [(conv, t, rng.choice(("user", "assistant")), rng.choice(words) * rng.randint(1, 2)) for t in range(n)]


def test_trie_equals_brute_force(spark):
    rng = random.Random(5)
    rows = [r for c in range(40) for r in talk(rng, c, rng.randint(1, 12))]
    rows += [(c, t, "user", "hot") for c in range(100, 130) for t in range(10)]  # one conversation, many copies
    rows += [(c, t, "user", f"{t % 3}") for c in (200, 201, 202, 203) for t in range(45)]  # three bands over bands
    rows += [(204, t, "user", f"{t % 3}" if t < 40 else "end") for t in range(44)]
    same_rows(trie_rows(spark, rows, 3), brute_trie(rows))


@pytest.mark.parametrize("height", [2, 16])
def test_trie_edges(spark, height):
    long = "wörd " * 20_000
    rows = [
        (1, None, "user", "first"),
        (1, 0, None, None),
        (1, 0, "", ""),  # the same turn again
        (1, 0, "user", "b"),
        (1, 0, "user", "a"),  # ties
        (7, 3, "user", long),
        (10, 1, "user", "x"),
        (13, 1, "user", "y"),  # some of these keep no turn
        (14, 1, "user", "y"),
        (-3, 1, "user", "z"),
        (-5, 2, "user", "z"),
        (9_000_000_000, 1, "user", "a"),
        (9_000_000_004, 1, "user", "a"),
        (None, 1, "user", "nobody's"),
    ]
    same_rows(trie_rows(spark, rows, height), brute_trie(rows))


def test_trie_empty_table(spark):
    assert trie_rows(spark, [], 4) == []
    assert trie_rows(spark, [(None, 1, "user", "x")], 4) == []


def test_ends_over_many_blocks(spark):
    ids = list(range(-5000, 9000))
    ends = spark.createDataFrame([(i, "n") for i in ids], "conv_id long, key string").repartition(7)
    want = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert [tuple(r) for r in prefix_trie.ends_digest(ends).collect()] == [("n", want)]


# Phrases


def brute_phrases(rows, longest, least, cover, scale, top):
    import re

    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + size])) for i in range(len(words) - size + 1))
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    covered = set()
    for (lang, words), a in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if 100 * a >= cover * f[lang, words[i : i + size]]:
                    covered.add((lang, words[i : i + size]))
    out = defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in covered:
            cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
            score, k = min((scale * a // (x + y), k) for k, (x, y) in enumerate(cuts))
            out[lang].append((-score, -a, " ".join(words).encode(), *cuts[k]))
    return [
        (lang, rank, p.decode(), -a, x, y, n[lang], -score)
        for lang, found in out.items()
        for rank, (score, a, p, x, y) in enumerate(sorted(found)[:top], 1)
    ]


def mined(spark, rows, period=2, **how):
    docs = spark.createDataFrame([(i, *r, "k", "c", 1, 2) for i, r in enumerate(rows)], DOCS)
    return [tuple(r) for r in phrases.mine(docs, period=period, **how).collect()]


HOW = {"longest": 4, "least": 3, "cover": 80, "scale": 2_000_000, "top": 50}


@pytest.mark.parametrize("period", [1, 2, 8])
def test_phrases_equal_brute_force(spark, period):
    rng = random.Random(period)
    rows = []
    for _ in range(120):
        words = [rng.choice("a B c d É f".split()) for _ in range(rng.randint(0, 40))]
        gaps = [rng.choice((" ", " ", "  ", "\t", ", ", ".", "\n", " \r")) for _ in words]
        rows.append(("".join(w + g for w, g in zip(words, gaps)), rng.choice(("en", "de", None))))
    same_rows(mined(spark, rows, period, **HOW), brute_phrases(rows, **HOW))


def test_phrases_edges(spark):
    assert mined(spark, [], **HOW) == []
    rows = [(None, "en"), ("", "en"), (" \t,;", None), ("one", "en")]
    assert mined(spark, rows, **HOW) == []
    long = " ".join(f"w{i % 7} same same same same" for i in range(20_000))
    rows += [(long, "en"), ("Same same", "en"), ("Same same", "en"), ("x\x00y z", None)] + [("x\x00y z", None)] * 3
    same_rows(mined(spark, rows, **HOW), brute_phrases(rows, **HOW))
    pairs = {**HOW, "longest": 2}
    same_rows(mined(spark, rows, **pairs), brute_phrases(rows, **pairs))


def test_chunks_own_every_word_once():
    rng = random.Random(3)
    words = [rng.choice("abcd") for _ in range(500)]
    inner, last = phrases.chunks_of([" ".join(words)], 3, 4)
    assert inner and len(last) == 1
    assert sum(c.count(b" ") + 1 - 3 for c in inner) + last[0].count(b" ") + 1 == 500
    again, _ = phrases.chunks_of(["zz " + " ".join(words)], 3, 4)
    assert set(inner[1:]) <= set(again)  # cut alike after another beginning


# Byte-level BPE


@pytest.fixture(scope="module")
def reference():
    with open(byte_bpe.default_path(), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def random_texts(n):
    rng = random.Random(11)
    signs = ["abcdefghijklmnopqrstuvwxyz", "aab", " \t\n\r", "éèüñß漢字かな한글Привет", "0123456789", "'sdtmrelv ", "!?.,-_", "\x85\xa0​\x1c🙂👩‍👧"]
    texts = ["".join(rng.choice(rng.choice(signs)) for _ in range(rng.randint(0, 40))) for _ in range(n)]
    return texts + ["".join(rng.choice(rng.choice(signs[:2])) for _ in range(rng.randint(200, 900))) for _ in range(n // 20)]


EDGES = [None, "", " ", "<|endoftext|>", "a" * 3000, "ab" * 700, " " * 600 + "x", "\n\n\n", "x" * 255, "y" * 256, "z" * 257]


def test_ids_and_bytes_equal_the_library(spark, reference):
    texts = random_texts(600) + EDGES + ["word and word " * 20_000]
    rows = [(i, t, "en", "clash", "c", 1, 2) for i, t in enumerate(texts)] + [(None, "null id", None, None, None, 1, 2)] * 2
    docs = spark.createDataFrame(rows, DOCS)
    got = byte_bpe.decode_ids(byte_bpe.encode_texts(docs)).collect()
    assert len(got) == len(rows)
    for row in got:
        text = "null id" if row.doc_id is None else texts[row.doc_id] or ""
        assert row.ids == reference.encode_ordinary(text), text[:40]
        assert bytes(row.decoded) == text.encode()


def test_query_digests(spark, reference):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = QUERIES["op13_byte_bpe"](spark, folder).collect()
    assert len(got) == len(texts)
    for row in got:
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()


def test_any_vocabulary_merges_in_order(tmp_path):
    """Ranks that no training gives: a merge can make a pair of lower rank than its own."""
    rng = random.Random(2)
    for trial in range(12):
        tokens = {bytes([b]) for b in range(256)}
        while len(tokens) < 330:
            tokens.add(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))))
        order = sorted(tokens, key=lambda t: (len(t) > 1, rng.random()))
        path = tmp_path / f"{trial}.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(order)))
        words = byte_bpe.Vocabulary(str(path), r"[^ ]+| +")
        own = tiktoken.Encoding("t", pat_str=r"[^ ]+| +", mergeable_ranks=words.ranks, special_tokens={})
        for _ in range(40):
            text = "".join(rng.choice("abc") for _ in range(rng.choice((7, 30, 300, 420))))
            ids, _ = words.encode([text])
            assert ids.tolist() == own.encode_ordinary(text)


def test_decoding_edges(spark):
    kind = "doc_id long, ids array<int>"
    empty = byte_bpe.encode_texts(spark.createDataFrame([], DOCS))
    assert empty.columns == ["doc_id", "ids"] and byte_bpe.decode_ids(empty).collect() == []
    got = byte_bpe.decode_ids(spark.createDataFrame([(1, None), (2, []), (3, [65, 66])], kind)).collect()
    words = byte_bpe.vocabulary(byte_bpe.default_path(), byte_bpe.default_pattern())
    plain, _ = words.decode(np.array([65, 66]))
    assert {r.doc_id: r.decoded and bytes(r.decoded) for r in got} == {1: None, 2: b"", 3: plain.tobytes()}
    with pytest.raises(Exception, match="no token"):
        byte_bpe.decode_ids(spark.createDataFrame([(1, [50256])], kind)).collect()
