"""The operators on small hand-made tables, beside brute force; edge cases of each."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterline.llm import (
    cgk_windows,
    common,
    crf_langid,
    line_hashing,
    mixing,
    mtree,
    signature_trees,
    suffix_runs,
    token_shards,
    toxic_grammar,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars int, key string, size int, n int"
A = "one two three four five six seven eight nine ten eleven twelve"
LONG = " ".join(f"w{i % 977}" for i in range(30_000))
EDGES = [
    (1, A, "en", "s"),
    (2, None, "en", "s"),
    (3, "", None, None),
    (4, " \t\n ", "en", "s"),
    (5, A, "en", None),
    (5, A, "en", None),
    (6, LONG, "en", "s"),
    (7, "12 34 !!", "en", "s"),
    (None, A, None, "t"),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(*r, 0, "k", 1, 2) for r in EDGES], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows(df, *columns):
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


# 1


def best(vectors, queries, k):
    ints = {i: np.floor(256 * np.asarray(v, dtype=np.float64)).astype(int) for i, v in vectors}
    out = []
    for q in queries:
        found = sorted((-int(ints[q] @ v), i) for i, v in ints.items() if i != q)
        out += [(q, r, i, -s) for r, (s, i) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def test_mtree_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = [(i, [float(x) for x in rng.normal(size=6).astype(np.float32)]) for i in range(400)]
    vectors += [(400 + i, vectors[7][1]) for i in range(5)]
    bad = [(900, None), (950, [1.0, float("nan")] * 3), (960, [None] * 6), (970, [float("inf")] * 6)]
    schema = "vec_id long, embedding array<float>, score long, rank int"
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in vectors + bad], schema)
    got = mtree.top_inner_products(df, df.where("vec_id % 50 = 0"), pivots=5, page_rows=40, block_rows=3)
    assert rows(got) == best(vectors, range(0, 401, 50), 5)


def test_mtree_few_and_no_rows(spark):
    schema = "vec_id long, embedding array<float>"
    two = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert rows(mtree.top_inner_products(two, two)) == [(0, 1, 1, 256 * 512), (1, 1, 0, 256 * 512)]
    assert rows(mtree.top_inner_products(two.limit(0), two.limit(0))) == []


# 2


def test_mix_reaches_targets(spark):
    random.seed(2)
    docs = [(i, "w " * random.randint(1, 30), random.choice("aabc"), "x") for i in range(600)]
    df = spark.createDataFrame([(i, t, None, s, 0, "k", 1, 2) for i, t, s, _ in docs], DOCS)
    got = mixing.mix(df).collect()
    for source in "abc":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 30
        assert all(r.taken <= 3 * r.size and r.taken % r.size == 0 for r in own)
    assert abs(sum({r.source: r.target for r in got}.values()) - sum(r.size for r in got)) < 1e-6
    again = mixing.mix_rows(df, mixing.mix(df)).groupBy("source").count().collect()
    assert {r.source for r in again} == set("abc")


def test_mix_edges(edges, empty):
    got = mixing.mix(edges)
    assert got.count() == len(EDGES)
    assert all(r.taken <= 3 * r.size for r in got.collect())
    assert rows(mixing.mix(empty)) == []


# 3


def test_units_keep_offsets():
    text = "Short. " + A + ". tail\n" + A.upper()
    for a, b, plain in line_hashing.text_units(text, 8):
        assert text[a:b].lower().strip(".") == plain.strip(".")
    assert len(line_hashing.text_units(text, 8)) == 2


def test_repeated_units_edges(edges, empty):
    got = rows(line_hashing.repeated_units(edges), "doc_id", "unit_start", "unit_end", "kept_doc_id")
    assert got == sorted([(5, 0, len(A), 1), (5, 0, len(A), 1), (None, 0, len(A), 1)], key=repr)
    assert rows(line_hashing.repeated_units(empty)) == []


def test_units_leave_the_text(spark):
    df = spark.createDataFrame([(1, A), (2, f"x\n{A}\ny")], "doc_id long, text string")
    removed = line_hashing.repeated_units(df)
    assert rows(line_hashing.without_units(df, removed)) == [(1, A), (2, "x\n\ny")]


# 4


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(3)
    model = crf_langid.Model(["a", "b"], None, None, rng.normal(size=(2, 2)), rng.normal(size=2))
    for n in (1, 5, 40):
        scores = rng.normal(size=(n, 2))
        got = crf_langid.posteriors(model, scores, np.array([n]))
        ahead = [np.exp(model.first + scores[0])]
        for k in range(1, n):
            ahead.append((ahead[-1] @ np.exp(model.moves)) * np.exp(scores[k]))
        back = np.ones(2)
        for k in range(n - 1, -1, -1):
            want = ahead[k] * back
            np.testing.assert_allclose(got[k], want / want.sum(), rtol=1e-6)
            back = np.exp(model.moves) @ (np.exp(scores[k]) * back)


def test_languages(spark, edges, empty):
    en = ["the thing and the other thing was there", "and then the thing ended there"] * 20
    fr = ["les choses sont dans la maison avec nous", "une chose avec la maison et les autres"] * 20
    model = crf_langid.fit(en + fr, ["en"] * 40 + ["fr"] * 40)
    docs = spark.createDataFrame(
        [(1, "the thing was there"), (2, "avec les choses"), (3, "the thing and the other les choses sont dans la maison")],
        "doc_id long, text string",
    )
    got = {r.doc_id: r for r in crf_langid.label_texts(docs, model).collect()}
    assert got[1].lang_pred == "en" and got[2].lang_pred == "fr"
    assert [r.lang for r in got[3].runs] == ["en", "fr"]
    marked = crf_langid.label_texts(edges, model).collect()
    assert len(marked) == len(EDGES)
    assert {r.doc_id for r in marked if r.lang_pred == "und"} == {2, 3, 4, 7}
    assert all(0 <= r.score <= 1 for r in marked)
    assert rows(crf_langid.label_texts(empty, model)) == []
    assert crf_langid.train(empty).labels == []
    assert {r.lang_pred for r in crf_langid.label_texts(docs, crf_langid.train(empty)).collect()} == {"und"}


# 5


def test_clause_roles():
    base = toxic_grammar.fit(["a"], [0])
    grammar = toxic_grammar.Grammar({"idiot": 2.0}, base.roles, np.ones(6), 0.0, np.zeros(6))
    assert grammar.clause("what an idiot".split()).tolist() == [2, 0, 0, 0, 0]
    assert grammar.clause("you are an idiot".split())[1] == 2
    assert grammar.clause("idiot are you".split())[1] == 2
    assert grammar.clause("he is not an idiot".split())[2] == 2
    assert grammar.clause("she said you idiot".split())[3] == 2
    assert grammar.clause("i will hurt you".split())[4] == 1
    assert grammar.clause("you i will hurt".split())[4] == 1
    assert grammar.clause("we are going to destroy them".split())[4] == 1
    assert grammar.clause("he kills people".split())[4] == 1
    assert grammar.clause("i will not hurt you".split())[4] == 0
    assert grammar.clause("she said i will hurt you".split())[4] == 0
    assert grammar.clause("i hurt my foot".split())[4] == 0
    assert grammar.clause("she said so and you are an idiot".split()).tolist() == [0, 2, 0, 0, 0]
    assert grammar.features("fine words. an idiot! more").tolist() == [2, 0, 0, 0, 0, 2]
    assert not grammar.features("nothing here").any() and not grammar.features(None).any()


def test_composition_equals_its_parts_one_by_one():
    """Each sum read off the words themselves: what stands before and after, and how far."""
    rng = random.Random(8)
    g = toxic_grammar
    words = {"idiot": g.INSULT, "hurt": g.THREAT, "you": g.TARGET, "not": g.NEGATION, "said": g.REPORT, "and": g.CONJUNCTION, "x": g.OTHER}
    grammar = g.Grammar({"idiot": 2.0}, {w: r for w, r in words.items() if w != "idiot"}, np.ones(6), 0.0, np.zeros(6))
    for _ in range(500):
        clause = [rng.choice(list(words)) for _ in range(rng.randint(1, 14))]
        want = [0.0] * 5
        for i, word in enumerate(clause):
            if word not in ("idiot", "hurt"):
                continue
            before = clause[:i]
            aimed, negated = "you" in before[-4:], "not" in before[-2:]
            since = len(before) - before[::-1].index("said") if "said" in before else None
            reported = since is not None and "and" not in before[since:]
            # The next target counts if it is near and no further word of this kind takes it.
            rest = clause[i + 1 : i + 6]
            follows = "you" in rest and word not in rest[: rest.index("you")]
            free = not (aimed or negated or reported)
            if word == "idiot":
                kind = 3 if reported else 2 if negated else 1 if aimed or follows else 0
                want[kind] += 2.0
            elif not (negated or reported) and (aimed or (free and follows)):
                want[4] += 1.0
        assert grammar.clause(clause).tolist() == want, clause


def test_toxic_learning(spark, edges, empty):
    random.seed(4)
    words = ["".join(random.choices("abcdefgh", k=6)) for _ in range(2000)]
    plain = lambda: " ".join(random.choices(words, k=30))
    docs = [(i, plain() + (" moron" if i % 3 == 0 else "")) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    marks = df.select("doc_id", (F.col("doc_id") % 3 == 0).cast("int").alias("toxic"))
    grammar = toxic_grammar.train(df, marks)
    assert any("moron".startswith(s) for s in grammar.stems)
    assert all(r.predicted == (r.doc_id % 3 == 0) for r in toxic_grammar.score_texts(df, grammar).collect())
    got = toxic_grammar.score_texts(edges, grammar).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score < 0.5 for r in got)
    assert rows(toxic_grammar.score_texts(empty, grammar)) == []
    assert toxic_grammar.train(empty, marks.limit(0)).stems == {}


# 6


def table_edits(item, text):
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_least_edits():
    random.seed(5)
    for _ in range(200):
        a = "".join(random.choices("abc", k=random.randint(1, 12)))
        b = "".join(random.choices("abc", k=random.randint(0, 20)))
        assert cgk_windows.least_edits(a, b) == table_edits(a, b)


def test_leaks_recall_and_edges(spark, edges, empty):
    random.seed(6)
    words = ["".join(random.choices("abcdefghij", k=random.randint(2, 9))) for _ in range(3000)]
    item = lambda n: " ".join(random.choices(words, k=n))
    items = [(i, item(random.randint(18, 60))) for i in range(100)] + [(200, "three short words"), (201, None), (202, "")]
    docs = []
    for i, text in items[:100]:
        own = [w for w in text.split() if random.random() > 0.04]
        docs.append((i, f"{item(50)} {' '.join(own)} {item(30)}"))
    docs += [(500 + i, item(80)) for i in range(50)] + [(600, "see THREE, short words here")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in cgk_windows.leaks(df, bench).collect()}
    assert (600, 200) in found
    assert not {d for d, _ in found} & set(range(500, 550))
    assert len({(i, i) for i in range(100)} & found) >= 95
    assert rows(cgk_windows.leaks(edges, bench)) == []
    assert rows(cgk_windows.leaks(empty, bench)) == rows(cgk_windows.leaks(df, bench.limit(0))) == []
    assert cgk_windows.without_leaks(edges, cgk_windows.leaks(edges, bench)).count() == len(EDGES)


# 7


def brute_runs(docs, size):
    seen, cut = set(), {}
    for d, text in sorted(docs):
        own = [(i, x.strip().lower()) for i, x in enumerate((text or "").split("\n")) if x.strip()]
        for k in range(len(own) - size + 1):
            run = tuple(x for _, x in own[k : k + size])
            if run in seen:
                cut.setdefault(d, set()).update(range(k, k + size))
            seen.add(run)
        cut[d] = (own, cut.get(d, set()))
    out = []
    for d, (own, gone) in cut.items():
        for k in sorted(gone):
            if k - 1 not in gone:
                end = k
                while end + 1 in gone:
                    end += 1
                out.append((d, own[k][0], own[end][0], end - k + 1))
    return sorted(out, key=repr)


def test_runs_equal_brute_force(spark, edges, empty):
    random.seed(7)
    docs = [(i, "\n".join(random.choices(["a", "b", "", "c ", f"u{i}"], k=random.randint(0, 12)))) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for size in (2, 3):
        got = suffix_runs.repeated_runs(df, min_lines=size)
        assert rows(got, "doc_id", "first_line", "last_line", "n_lines") == brute_runs(docs, size)
    assert rows(suffix_runs.repeated_runs(edges)) == rows(suffix_runs.repeated_runs(empty)) == []


# 8


def brute_groups(docs, width, num, den):
    sets = {}
    for d, text in docs:
        w = (text or "").lower().split()
        sets[d] = {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()
    links = common.Links(len(docs))
    ids = [d for d, _ in docs]
    for i, a in enumerate(ids):
        for j in range(i):
            x, y = sets[a], sets[ids[j]]
            if x and y and den * len(x & y) >= num * len(x | y):
                links.join(i, j)
    return sorted(((d, len(sets[d]), ids[links.root(i)]) for i, d in enumerate(ids)), key=repr)


@pytest.mark.parametrize("limits", [{}, {"group_rows": 3, "block_shingles": 60}])
def test_jaccard_equals_brute_force(spark, limits):
    random.seed(8)
    base = [[random.choice("abcdefghijkl") + random.choice("xyz") for _ in range(random.randint(3, 60))] for _ in range(25)]
    docs = []
    for i in range(120):
        own = list(random.choice(base))
        for _ in range(random.choice((0, 0, 1, 2, 4))):
            own[random.randrange(len(own))] = random.choice(("new", "other", "ax"))
        docs.append((i, " ".join(own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = signature_trees.jaccard_components(df, width=4, num=85, den=100, **limits)
    assert rows(got) == brute_groups(docs, 4, 85, 100)


def test_jaccard_edges(edges, empty):
    got = signature_trees.jaccard_components(edges)
    assert [(r[0], r[2]) for r in rows(got)] == sorted(
        [(1, 1), (2, 2), (3, 3), (4, 4), (5, 1), (5, 1), (6, 6), (7, 7), (None, 1)], key=repr
    )
    assert {r[0]: r[1] for r in rows(got)}[4] == 0
    kept = signature_trees.first_of_groups(edges, got)
    assert kept.columns == edges.columns
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7]
    assert rows(signature_trees.jaccard_components(empty)) == []


def test_tree_prunes_nothing_true():
    random.seed(9)
    sets = []
    for _ in range(150):
        s = set(random.choices(range(400), k=60)) if not sets or random.random() < 0.5 else set(random.choice(sets))
        for _ in range(random.randint(0, 6)):
            s.add(random.randrange(400))
        sets.append(s)
    arrays = [np.array(sorted(common.mixed(np.array(list(s), dtype=np.uint64)))) for s in sets]
    same = lambda i, j: 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j])
    got, want = common.Links(150), common.Links(150)
    for a, b in signature_trees.tree_links(
        np.array([len(a) for a in arrays]), [signature_trees.signature(a) for a in arrays], 85, 100, same
    ):
        got.join(a, b)
    for i in range(150):
        for j in range(i):
            if same(i, j):
                want.join(i, j)
    assert [got.root(i) for i in range(150)] == [want.root(i) for i in range(150)]


def test_components(spark):
    pairs = [(i, i + 1) for i in range(30)] + [(50, 40), (50, 60), (7, 7)]
    got = common.components(spark.createDataFrame(pairs, "a long, b long"))
    assert rows(got) == sorted([(i, 0) for i in range(31)] + [(i, 40) for i in (40, 50, 60)], key=repr)
    assert rows(common.components(spark.createDataFrame([], "a long, b long"))) == []


# 9


@pytest.mark.parametrize("size", [1, 2, 5, 64, 1000, 4097])
def test_feistel_is_a_permutation(size):
    out = token_shards.feistel(np.arange(size), size, 7)
    assert sorted(out.tolist()) == list(range(size))
    assert size < 64 or out.tolist() != token_shards.feistel(np.arange(size), size, 8).tolist()


def test_shards_round_trip(edges, empty):
    shards = token_shards.write_shards(edges, stride=64, shard_rows=16)
    encode = token_shards.Encoder()
    texts: dict = {}
    for s in shards.collect():
        assert len(s.body) == s.records * 128
        for i, (doc, part, n) in enumerate(zip(s.docs, s.parts, s.lengths)):
            ids = np.frombuffer(s.body[i * 128 : i * 128 + 2 * n], dtype="<u2")
            texts.setdefault((doc, part), ids)
    whole = lambda d: encode.decode(np.concatenate([v for k, v in sorted(texts.items(), key=repr) if k[0] == d] or [[]]))
    assert whole(1) == A and whole(3) == "" and (2, 0) not in texts
    parts = [texts[6, p] for p in range(sum(k[0] == 6 for k in texts))]
    assert encode.decode(np.concatenate(parts)) == LONG
    records = token_shards.read_records(shards, 64).select("slot").collect()
    assert sorted(r.slot for r in records) == list(range(len(records)))
    assert rows(token_shards.read_records(token_shards.write_shards(empty))) == []


# 10


def test_url_rules(spark):
    rules = url_filter.rule_table(
        spark, [("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/e", "block"), ("net", "/en/x", "allow")]
    )
    pages = [
        (1, "http://A.Example.COM/en/1?q#f", "a.example.com", "/en/1", "example.com/en/", "block"),
        (2, "x://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
        (3, "http://example.com", "example.com", "", None, "allow"),
        (4, "http://b.net/en/xy", "b.net", "/en/xy", "net/en/x", "allow"),
        (5, "http://b.net/ez", "b.net", "/ez", "net/e", "block"),
        (6, None, "", "", None, "allow"),
        (7, "no scheme", "", "", None, "allow"),
        (7, "no scheme", "", "", None, "allow"),
        (None, "http://net/e?", "net", "/e", "net/e", "block"),
        (9, "http://" + "a." * 5000 + "com/" + "p" * 50000, "a." * 5000 + "com", "/" + "p" * 50000, "com/", "allow"),
    ]
    df = spark.createDataFrame([(p[0], p[1], "h", "r", "v") for p in pages], "page_id long, url string, host string, rule string, verdict string")
    got = url_filter.judge_urls(df, rules)
    assert rows(got) == sorted([(p[0], *p[2:]) for p in pages], key=repr)
    assert rows(url_filter.judge_urls(df.limit(0), rules)) == []
    assert {r.verdict for r in url_filter.judge_urls(df, rules.limit(0)).collect()} == {"allow"}
