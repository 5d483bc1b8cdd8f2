"""Exact top-k inner products with a paged M-tree.

Vectors become integers, ``floor(scale * x)``. Let ``R`` be the largest squared length.
With one more coordinate ``sqrt(R - |x|^2)`` for stored vectors (0 for queries) the squared
Euclidean distance is ``|q|^2 + R - 2 q.x``, so the largest inner products are the nearest
neighbours of a metric and an M-tree can search them.

The tree has three levels. A bounded number of routing objects (``pivots``, a documented
sample) form the root; every vector goes to its nearest one. Below each pivot its rows are
dealt to pages by a hash of the id, so pages have no radius and every page of a wanted pivot
is searched; each page is cut into nodes of ``fan`` entries. A
node keeps a routing object, its covering radius and its distance to the pivot (parent
distance); an entry keeps its distance to the node's object. Inside a page best-first search
takes nodes by their lower bound; it leaves out a distance computation where the
difference of two stored distances already exceeds the current k-th distance.

Queries travel in blocks. First each searches the pages of its nearest pivot, which gives
an upper bound of its k-th distance; then only the pivots whose covering radius that bound
reaches. Pages and pivots with very many rows are several pages in different tasks.

Defined results: a vector that is null or holds a null, NaN or infinity takes no part. A
missing component counts as 0, an empty vector is the null vector. Ties go to the smaller
id; rows with equal ids are rows of their own as candidates, and as queries count once
each distinct vector. Fewer candidates than ``k`` give fewer rows, an empty table none.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterline.llm.common import key_lists
from meterline.session import stored

#: Distances are doubles of exact integers up to a root; this covers their rounding.
SLACK = 1e-6


def quantised(vectors: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """id and ``v``, the integer components, of the vectors that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    x = F.col(vector)
    return (
        vectors.where(x.isNotNull() & F.col(key).isNotNull())
        .where(F.forall(x, finite))
        .select(
            F.col(key).cast("long").alias("id"),
            F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("v"),
        )
    )


def _matrix(rows: list, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.float64)
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, most - np.einsum("ij,ij->i", x, x)))
    return np.hstack([x, rest[:, None]])


def _far(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances between the rows of ``a`` and ``b``."""
    squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :]
    return np.sqrt(np.maximum(0.0, squares - 2.0 * (a @ b.T)))


class Page:
    """Nodes of an M-tree page: routing objects, radii, parent distances and entries."""

    def __init__(self, ids, points, to_pivot, fan: int = 64):
        order = np.lexsort((ids, to_pivot))
        self.nodes = []
        for at in range(0, len(order), fan):
            rows = order[at : at + fan]
            route = points[rows[len(rows) // 2]]
            near = _far(points[rows], route[None, :])[:, 0]
            by = np.argsort(near, kind="stable")
            self.nodes.append(
                (route, float(near.max()), float(to_pivot[rows[len(rows) // 2]]), ids[rows][by], points[rows][by], near[by])
            )

    def search(self, query, query_id, to_pivot: float, best: list, k: int, bound: float) -> int:
        """Adds to ``best`` (a heap of (score, -id)) what is among the ``k`` best.

        ``bound`` is a known upper bound of the k-th distance. Returns how many distances
        were computed.
        """
        computed = 0
        square = float(query @ query)
        queue = []
        for i, (route, radius, parent, *_) in enumerate(self.nodes):
            low = abs(to_pivot - parent) - radius
            heapq.heappush(queue, (max(0.0, low), 0, i, 0.0))
        while queue:
            low, known, i, near = heapq.heappop(queue)
            if low > bound + SLACK:
                break
            route, radius, _, ids, points, stored_distance = self.nodes[i]
            if not known:
                near = float(np.sqrt(max(0.0, square + float(route @ route) - 2.0 * float(query @ route))))
                computed += 1
                heapq.heappush(queue, (max(low, near - radius), 1, i, near))
                continue
            # Entries outside the ring near +- bound cannot be among the best.
            a, b = np.searchsorted(stored_distance, [near - bound - SLACK, near + bound + SLACK])
            ids, points = ids[a:b], points[a:b]
            other = ids != query_id
            scores = np.rint(points[other, :-1] @ query[:-1]).astype(np.int64)
            computed += len(scores)
            for s, v in zip(scores.tolist(), ids[other].tolist()):
                item = (s, -v)
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                # squared distance = |q|^2 + R - 2 score, where |point|^2 = R for every point
                bound = min(bound, float(np.sqrt(max(0.0, square + self.most - 2.0 * best[0][0]))))
        return computed

    most = 0.0


def _assign(pivots: np.ndarray, width: int, most: float, page_rows: int) -> Callable:
    def run(batches):
        for batch in batches:
            rows = batch["v"].tolist()
            for at in range(0, len(rows), 2000):
                some = rows[at : at + 2000]
                far = _far(_lift(_matrix(some, width), most), pivots)
                nearest = far.argmin(axis=1)
                yield pd.DataFrame(
                    {
                        "id": batch["id"].iloc[at : at + 2000].to_numpy(),
                        "v": [np.asarray(r, dtype="<i8").tobytes() for r in some],
                        "pivot": nearest.astype(np.int32),
                        "far": far[np.arange(len(some)), nearest],
                    }
                )

    return run


def _search(pivots: np.ndarray, width: int, most: float, k: int) -> Callable:
    """Searches (page, block of queries) pairs; one output row for each find."""

    def run(batches):
        for rows in key_lists(batches, ("pivot", "page"), ("pivot", "ids", "vectors", "fars", "block")):
            page = None
            for pivot, ids, vectors, fars, block in rows:
                if page is None:
                    ids = np.asarray(ids)
                    points = _matrix([np.frombuffer(v, dtype="<i8") for v in vectors], width)
                    page = Page(ids, _lift(points, most), np.asarray(fars))
                    page.most = most
                found: list = []
                for q in block:
                    vector = np.zeros(width + 1)
                    raw = np.frombuffer(q["v"], dtype="<i8")
                    vector[: len(raw)] = raw
                    to_pivot = float(_far(vector[None, :], pivots[pivot][None, :])[0, 0])
                    best: list = []
                    page.search(vector, q["id"], to_pivot, best, k, q["bound"])
                    found.extend((q["id"], q["v"], -v, s) for s, v in best)
                yield pd.DataFrame(found, columns=["query_id", "qv", "vec_id", "score"])

    return run


def _bounds(pivots: np.ndarray, radii: np.ndarray, width: int) -> Callable:
    """The pivots a query still has to visit, given its bound (all but the visited one)."""

    def run(batches):
        for batch in batches:
            rows: list = []
            for q, v, home, bound in batch[["id", "v", "home", "bound"]].itertuples(index=False):
                vector = np.zeros(width + 1)
                raw = np.frombuffer(v, dtype="<i8")
                vector[: len(raw)] = raw
                far = _far(vector[None, :], pivots)[0]
                wanted = np.flatnonzero((far - radii <= bound + SLACK) & (radii >= 0))
                rows.extend((q, v, bound, int(p)) for p in wanted if p != home)
            yield pd.DataFrame(rows, columns=["id", "v", "bound", "pivot"])

    return run


def top_inner_products(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = 5,
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    pivots: int = 64,
    page_rows: int = 2048,
    block_rows: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best other rows for every query row."""
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score long"
    rows = quantised(vectors, key, vector, scale)
    asked = quantised(queries, key, vector, scale).dropDuplicates(["id", "v"])
    square = F.aggregate("v", F.lit(0).cast("long"), lambda a, c: a + c * c)
    most, width, query_width = (
        rows.agg(F.max(square), F.max(F.size("v"))).first() + asked.agg(F.max(F.size("v"))).first()
    )
    if most is None or query_width is None:
        return spark.createDataFrame([], schema)
    most, width = float(most), max(width, query_width, 1)
    # Routing objects: the vectors with the smallest id hashes, at most ``pivots`` of them.
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    routes = _lift(_matrix([r["v"] for r in sample], width), most)

    placed = rows.mapInPandas(
        _assign(routes, width, most, page_rows), "id long, v binary, pivot int, far double"
    )
    placed = stored(placed, "mtree-rows")
    # One row for each pivot.
    stats = placed.groupBy("pivot").agg(F.count("*").alias("rows"), F.max("far").alias("radius")).collect()
    radii = np.full(len(routes), -1.0)
    pages_of = {}
    for s in stats:
        radii[s["pivot"]] = s["radius"]
        pages_of[s["pivot"]] = -(-s["rows"] // page_rows)
    parts = spark.createDataFrame(sorted(pages_of.items()), "pivot int, pages int")
    page = F.pmod(F.xxhash64("id"), F.col("pages")).cast("int")
    pages = (
        placed.join(F.broadcast(parts), "pivot")
        .withColumn("page", page)
        .groupBy("pivot", "page")
        .agg(
            F.collect_list(F.struct("id", "v", "far")).alias("rows"),
        )
        .select(
            "pivot", "page", F.col("rows.id").alias("ids"), F.col("rows.v").alias("vectors"), F.col("rows.far").alias("fars")
        )
    )
    pages = stored(pages, "mtree-pages")

    # Queries are not lifted, so their nearest pivot is found apart from the rows'.
    def home(batches):
        for batch in batches:
            found = []
            for v in batch["v"].tolist():
                q = np.zeros(width + 1)
                q[: len(v)] = v
                found.append(int(np.where(radii >= 0, _far(q[None, :], routes)[0], np.inf).argmin()))
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "v": [np.asarray(v, dtype="<i8").tobytes() for v in batch["v"].tolist()],
                    "pivot": np.array(found, dtype=np.int32),
                    "bound": np.inf,
                }
            )

    first = stored(asked.mapInPandas(home, "id long, v binary, pivot int, bound double"), "mtree-queries")

    def searched(queries_: DataFrame) -> DataFrame:
        salt = F.pmod(F.xxhash64("id"), F.greatest(F.lit(1), F.ceil(F.col("asked") / block_rows))).cast("int")
        counts = queries_.groupBy("pivot").agg(F.count("*").alias("asked"))
        blocks = (
            queries_.join(F.broadcast(counts), "pivot")
            .withColumn("salt", salt)
            .groupBy("pivot", "salt")
            .agg(F.collect_list(F.struct("id", "v", "bound")).alias("block"))
        )
        pairs = pages.join(blocks, "pivot").repartition("pivot", "page", "salt")
        return pairs.sortWithinPartitions("pivot", "page").mapInPandas(
            _search(routes, width, most, k), "query_id long, qv binary, vec_id long, score long"
        )

    best = Window.partitionBy("query_id", "qv").orderBy(F.desc("score"), "vec_id")
    near = stored(
        searched(first).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k), "mtree-near"
    )
    kth = near.groupBy("query_id", "qv").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    query_square = F.udf(lambda v: float((np.frombuffer(v, dtype="<i8").astype(np.float64) ** 2).sum()), "double")
    bounded = (
        first.alias("f")
        .join(kth.alias("t"), (F.col("f.id") == F.col("t.query_id")) & (F.col("f.v") == F.col("t.qv")), "left")
        .select(
            "f.id",
            "f.v",
            F.col("f.pivot").alias("home"),
            F.when(
                F.col("t.n") >= k,
                F.sqrt(F.greatest(F.lit(0.0), query_square("f.v") + F.lit(most) - 2 * F.col("t.least"))),
            )
            .otherwise(F.lit(float("inf")))
            .alias("bound"),
        )
    )
    rest = stored(
        bounded.mapInPandas(_bounds(routes, radii, width), "id long, v binary, bound double, pivot int"), "mtree-rest"
    )
    both = near.drop("rank").unionByName(searched(rest))
    return (
        both.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
