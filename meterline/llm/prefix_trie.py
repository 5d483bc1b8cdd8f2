"""The prefix trie of conversations, rolled up in depth bands.

Conversations are sequences of turns; each distinct sequence of the first d turns is a
node at depth d, the empty one the root. Turns are numbered without holding a conversation
in one task, and a node is known by a 128-bit digest of its turns: positions are cut into
bands of ``height`` turns, a band's digests follow from the turns in it, and the sequence
of a conversation's bands is digested in the same way, band over band.

Sums over subtrees take the same bands. A node explodes only to its ancestors within its
band, at most ``height`` rows, which completes all sums inside the bands. The roots of the
bands form a tree that is lower by the factor ``height``; it is rolled up likewise, and
the completed total of each band root explodes to the ancestors of its parent within the
band above. So there are log(depth) rounds, and no row explodes to more than ``height``.
Hot nodes (a first turn that a third of all conversations share) are summed before each
shuffle.

The digest of the members that end at a node needs them in order: blocks of 4,096
consecutive ids become text in parallel, and one pass over a node's blocks hashes them in
a stream.

Defined results: turns are ordered by their number (null first), ties by the digest of
role and text. Null roles and texts are empty ones. Repeated rows are turns each. Rows
without a conversation id take no part. A very long conversation or text is one like any
other. An empty table has no node, not even a root. Only the four columns are read, so
others may have any name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import ranked
from meterline.session import stored

#: Ids of one block of a node's ends, as a power of two.
BLOCK_BITS = 12
ROOT = "root"


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, item, n_bytes): all turns numbered from 0 in each conversation.

    ``item`` is a digest of role and text, ``n_bytes`` the size of the text in UTF-8.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("item"),
        F.octet_length(text).cast("long").alias("n_bytes"),
    )
    placed = stored(ranked(rows, "conv_id", "turn", "item", name="turns", column="row"), "turns")
    starts = placed.groupBy("conv_id").agg(F.min("row").alias("start"))
    return placed.join(starts, "conv_id").select("conv_id", (F.col("row") - F.col("start")).alias("pos"), "item", "n_bytes")


def grafted(turns: DataFrame, base: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of another: the new turns, and all ids.

    A conversation gets the first ``head`` turns of the conversation ``base`` (all if it
    has fewer, none if it is absent), then its own turns after its first ``head``. Both are
    columns of ``conv_id``; ``head`` is at most ``most``.
    """
    heads = turns.where(F.col("pos") < most).withColumnRenamed("conv_id", "base")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("conv_id", base.alias("base"), head.alias("head"))
    sizes = heads.groupBy("base").agg(F.count(F.lit(1)).alias("size"))
    convs = convs.join(sizes, "base", "left").withColumn(
        "given", F.least(F.col("head"), F.coalesce(F.col("size"), F.lit(0)))
    )
    first = convs.join(heads, "base").where("pos < head").select("conv_id", "pos", "item", "n_bytes")
    own = turns.join(convs, "conv_id").where("pos >= head")
    own = own.select("conv_id", (F.col("pos") - F.col("head") + F.col("given")).alias("pos"), "item", "n_bytes")
    return first.unionByName(own), convs.select("conv_id")


def _bands(height: int) -> tuple[Column, object]:
    return F.floor(F.col("pos") / height).alias("band"), Window.partitionBy("conv_id", "band").orderBy("pos")


def prefix_keys(seq: DataFrame, deepest: int, height: int) -> DataFrame:
    """``seq`` (conv_id, pos, item) with ``key``, the identity of the items up to ``pos``,
    and ``before``, the key one position earlier (null at 0).
    """
    band, inside = _bands(height)
    rows = seq.select("*", band).withColumn("local", F.md5(F.array_join(F.collect_list("item").over(inside), "")))
    if deepest < height:
        rows = rows.withColumn("key", F.col("local")).withColumn("_up", F.lit(None).cast("string"))
    else:
        ends = rows.groupBy("conv_id", "band").agg(F.max_by("local", "pos").alias("item"))
        above = prefix_keys(ends.withColumnRenamed("band", "pos"), deepest // height, height)
        above = above.select("conv_id", F.col("pos").alias("band"), F.col("key").alias("_whole"), F.col("before").alias("_up"))
        rows = rows.join(above, ["conv_id", "band"])
        # The last place of a band is the whole of it; others add to the band before.
        key = F.when(F.col("pos") % height == height - 1, F.col("_whole"))
        key = key.when(F.col("_up").isNull(), F.col("local"))
        rows = rows.withColumn("key", key.otherwise(F.md5(F.concat("_up", "local")))).drop("_whole")
    before = F.coalesce(F.lag("key").over(inside), F.col("_up"))
    return rows.withColumn("before", before).drop("band", "local", "_up")


def rolled_up(paths: DataFrame, values: DataFrame, deepest: int, height: int, names: tuple[str, ...]) -> DataFrame:
    """(key, sums): ``values`` (key and named numbers) summed over each node's subtree.

    ``paths`` (conv_id, pos, key, before) has the nodes along each conversation.
    """
    band, inside = _bands(height)
    nodes = (
        paths.select("*", band)
        .withColumn("path", F.collect_list("key").over(inside))
        .groupBy("key")
        .agg(F.first("path").alias("path"), F.first("pos").alias("pos"), F.first("before").alias("before"))
    )
    if deepest >= height:
        nodes = stored(nodes, "trie_band")
    total = [F.sum(n).alias(n) for n in names]
    exploded = nodes.join(values, "key").select(F.explode("path").alias("key"), *names)
    inner = exploded.groupBy("key").agg(*total)
    if deepest < height:
        return inner
    inner = stored(inner, "trie_sums")
    at_top = F.col("pos") % height == 0
    roots = nodes.where(at_top).select("key", "before")
    tops = paths.where(at_top).select("conv_id", (F.col("pos") / height).cast("long").alias("pos"), "key")
    up = Window.partitionBy("conv_id", F.floor(F.col("pos") / height)).orderBy("pos")
    last = tops.where(F.col("pos") % height == height - 1).select("conv_id", (F.col("pos") + 1).alias("pos"), F.col("key").alias("_up"))
    tops = tops.withColumn("_lag", F.lag("key").over(up)).join(last, ["conv_id", "pos"], "left")
    tops = tops.select("conv_id", "pos", "key", F.coalesce("_lag", "_up").alias("before"))
    # The parent of a band root at this level is the node above it, not the root above.
    done = rolled_up(tops, roots.select("key").join(inner, "key"), deepest // height, height, names)
    parents = nodes.select(F.col("key").alias("before"), "path")
    passed = roots.where("before is not null").join(done, "key").join(parents, "before")
    passed = passed.select(F.explode("path").alias("key"), *names)
    return inner.unionByName(passed).groupBy("key").agg(*total)


def _hash_in_order(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One digest for the consecutive rows of a key: their texts joined by commas."""
    now, digest = None, None
    for batch in batches:
        out = []
        for key, ids in zip(batch["key"], batch["ids"]):
            if key != now:
                if digest is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        yield pd.DataFrame(out, columns=["key", "ends_sha256"])
    if digest is not None:
        yield pd.DataFrame([(now, digest.hexdigest())], columns=["key", "ends_sha256"])


def ends_digest(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ascending ids of ``ends`` (conv_id, key) at each key."""
    blocks = (
        ends.groupBy("key", F.shiftright("conv_id", BLOCK_BITS).alias("block"))
        .agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    )
    ordered = blocks.repartition("key").sortWithinPartitions("key", "block").select("key", "ids")
    return ordered.mapInPandas(_hash_in_order, "key string, ends_sha256 string")


def trie(seq: DataFrame, convs: DataFrame, height: int = 16) -> DataFrame:
    """The nodes of the trie over the sequences ``seq`` (conv_id, pos, item, n_bytes).

    ``convs`` (conv_id) has every conversation, also those without turns. Columns: conv_id
    (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256. ``saved_tokens`` adds up, over the subtree, a node's members
    but one, times the bytes of its last text.
    """
    if height < 2:
        raise ValueError("a band has two positions at least")
    seq, convs = stored(seq, "trie_turns"), stored(convs.select("conv_id"), "trie_convs")
    deepest = seq.agg(F.max("pos")).first()[0] or 0
    rows = stored(prefix_keys(seq, deepest, height), "trie_keys")
    nodes = stored(
        rows.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"),
            F.first("pos").alias("pos"),
            F.first("before").alias("before"),
            F.count(F.lit(1)).alias("n_convs"),
            F.first("n_bytes").alias("n_bytes"),
        ),
        "trie_nodes",
    )
    children = nodes.groupBy(F.coalesce("before", F.lit(ROOT)).alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    children = stored(children, "trie_children")
    nodes = nodes.join(children, "key", "left").fillna(0, ["n_children"])
    own = nodes.select(
        "key",
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
        ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"),
    )
    sums = ("n_leaves", "saved_tokens")
    paths = rows.select("conv_id", "pos", "key", "before")
    totals = stored(rolled_up(paths, own, deepest, height, sums), "trie_totals")
    lengths = rows.groupBy("conv_id").agg(F.max_by("key", "pos").alias("key"))
    ends = convs.join(lengths, "conv_id", "left").select("conv_id", F.coalesce("key", F.lit(ROOT)).alias("key"))
    digests = ends_digest(ends)

    below = nodes.join(totals, "key").select(
        "key", "conv_id", (F.col("pos") + 1).alias("depth"), F.coalesce("before", F.lit(ROOT)).alias("up"), "n_convs", "n_children", *sums
    )
    top = _root(convs, nodes, totals)
    every = stored(below.unionByName(top), "trie")
    parents = every.where("n_children > 0").select(F.col("key").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    return (
        every.join(parents, "up", "left")
        .join(digests, "key", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", *sums,
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )


def _root(convs: DataFrame, nodes: DataFrame, totals: DataFrame) -> DataFrame:
    """The root's row, from two rows of sums; none if there is no conversation."""
    members = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    first = nodes.where("pos = 0").join(totals, "key")
    below = first.agg(
        F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens")
    )
    both = members.unionByName(below, allowMissingColumns=True)
    both = both.agg(*[F.max(c).alias(c) for c in both.columns]).where("n_convs > 0")
    return both.select(
        F.lit(ROOT).alias("key"),
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("string").alias("up"),
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).cast("long").alias("saved_tokens"),
    )
