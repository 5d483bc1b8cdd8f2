"""The candidates of the near-copy join: no linked pair is missed, unrelated texts stay apart."""

import random

import numpy as np
import pytest

from meterline.llm import common, signature_trees


def words(n, r):
    return [f"w{r.randrange(10**9)}" for _ in range(n)]


@pytest.fixture
def edges_of(monkeypatch):
    """The frames of pairs that the join connects, by name."""
    found = {}

    def kept(edges, name="components", **more):
        found[name] = edges
        return common.components(edges, name, **more)

    monkeypatch.setattr(signature_trees, "components", kept)
    return found


def passages(r):
    """Each two of 16 long texts share a passage, which is a short text as well."""
    texts = [[] for _ in range(16)]
    short = []
    for i in range(16):
        for j in range(i):
            passage = words(60, r)
            texts[i] += passage
            texts[j] += passage
            short.append(passage)
    return texts + short


def test_passages_in_common_link_no_long_texts(spark, edges_of):
    texts = passages(random.Random(3))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = signature_trees.jaccard_components(docs)
    assert all(r.component_id == r.doc_id for r in got.collect())
    # They were one block of texts before, as bitmaps of long ones were folded to a short one's.
    assert edges_of["jaccard-near"].where("a <> b").count() == 0


def test_only_texts_of_blocks_are_shuffled(spark, edges_of):
    r = random.Random(4)
    base = words(80, r)
    texts = [words(80, r) for _ in range(20)] + [base, base[:79]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = signature_trees.jaccard_components(docs)
        plan = edges_of["jaccard-links"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert {r.component_id for r in got.where("doc_id >= 20").collect()} == {20}
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_one_of_each_leaves_the_texts_where_they_are(spark):
    rows = [(5, "a b c d e f", 0), (3, "a b c d e f", 1), (None, "a b c d e f", 2), (3, "x y z", 3), (3, "", 4), (3, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    groups = signature_trees.jaccard_components(docs, key="_row")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = signature_trees.one_of_each(docs, groups, row="_row")
        plan = kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert sorted(r._row for r in kept.collect()) == [1, 3, 4, 5]
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_rows_beyond_the_broadcast_limit(spark, monkeypatch):
    monkeypatch.setattr(common, "MOST_KEYS", 0)
    monkeypatch.setattr(signature_trees, "MOST_KEYS", 0)
    rows = [(i, "a b c d e f g" if i % 2 else f"u{i} v w x y z", i) for i in range(9)] + [(None, "a b c d e f g", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long")
    groups = signature_trees.jaccard_components(docs, key="_row")
    kept = signature_trees.one_of_each(docs, groups, row="_row")
    assert sorted(r._row for r in kept.collect()) == [0, 1, 2, 4, 6, 8]


@pytest.mark.parametrize("num", [50, 80, 85, 100])
def test_every_linked_pair_shares_a_group(num):
    r = random.Random(num)
    base = [[r.getrandbits(64) for _ in range(r.choice((2, 9, 40, 1500)))] for _ in range(12)]
    common_part = [r.getrandbits(64) for _ in range(30)]
    held, sets = [], {}
    order = {}
    for k in range(150):
        s = set(r.choice(base))
        for _ in range(r.choice((0, 1, 2, len(s) // 9))):
            s.discard(next(iter(s)))
            s.add(r.getrandbits(64))
        s |= set(r.sample(common_part, r.choice((0, 0, 3))))
        ranks = sorted(s, key=lambda x: order.setdefault(x, r.random()))
        n = len(ranks)
        sets[k] = s
        early = n - -(-2 * num * n // (num + 100)) + 1
        held.append((np.array(ranks[: n - -(-num * n // 100) + 1], dtype=np.uint64), k, n, early))
    packed = signature_trees._packed(held, 7)
    pairs = set()
    seen = {}
    for data in packed["data"]:
        shingles, names, marks = signature_trees._unpacked([data])
        assert len(data) == 17 * len(shingles)
        for g1, g2, part, members, body in signature_trees._bucket_groups(shingles, names, marks, num, 100):
            ids = np.frombuffer(body, dtype="<i8").tolist()
            assert members == len(ids) > 1 and part == 0
            assert seen.setdefault((g1, g2), ids) == ids
            pairs.update((a, b) for a in ids for b in ids if a < b)
    want = {(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])}
    assert want and want <= pairs


def test_signatures_of_one_length_are_compared(spark):
    r = np.random.default_rng(5)
    large = [np.unique(r.integers(0, 2**63, 3000, dtype=np.uint64)) for _ in range(6)]
    large.append(np.union1d(large[0], r.integers(0, 2**63, 60, dtype=np.uint64)))
    small = [np.unique(r.integers(0, 2**63, 40, dtype=np.uint64)) for _ in range(3)]
    # On either side of the size at which a bitmap doubles.
    edge = np.unique(r.integers(0, 2**63, 2050, dtype=np.uint64))
    sets = [*large, *small, edge, edge[:2040]]
    sizes, bits = np.array([len(s) for s in sets]), [signature_trees.signature(s) for s in sets]
    assert len(bits[-1]) * 2 == len(bits[-2])
    got = {tuple(sorted(x)) for x in signature_trees.sized_links(sizes, bits, 80, 100)}
    assert got == {(0, 6), (10, 11)}
    assert {tuple(sorted(x)) for x in signature_trees.sized_links(sizes, bits, 80, 100, sides=sizes * 0)} == set()


def test_counters_keep_their_counts():
    a = np.array([0, 1, 255, 256, 70_000, 2**32 - 1, 2**40], dtype=np.int64)
    assert signature_trees._counted(signature_trees._counters(a)).tolist() == [0, 1, 255, 256, 70_000, 2**32 - 1, 2**32 - 1]
