"""Exact top-k by inner product: a ball tree per shard, searched best bound first.

Components x become ``floor(SCALE * x)``, so scores are whole numbers. Vectors are dealt to
shards of about ``SHARD_ROWS`` rows. A shard's task builds a ball tree of its rows and then
reads the queries one batch after another; it never holds more than its rows and a batch.

Nodes are opened in the order of their upper bound ``q . centre + |q| * radius``. A node is
left out when its bound is below the k-th score found so far, or equal to it with no smaller
id in the node. The k-th score is shared between shards: a first pass searches each query in
one shard, and its k-th result travels with the query to all the others, which start from it.

The result is exact, ties going to the smaller id. Equal vectors of a node are looked at only
as far as the k + 1 smallest ids, which are all that can count.

Vectors that are NULL or hold a NULL or non-finite component take no part. A query is compared
with vectors of its own length only, and not with rows of its own id. Every query row has its
own result, repeated rows too. Scores beyond 64 bits become the largest or smallest number.
NULL ids are no queries and come last among ties. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallyloom import store
from tallyloom.llm import common

SCALE = 1024.0
SHARD_ROWS = 16_384
LEAF = 64
EXACT = 2.0**52
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not NULL, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


class BallTree:
    """Nodes in arrays; the rows of a node are one slice of ``rows``, smallest ids first in leaves."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray):
        self.rows, self.ids = rows, ids
        self.centre, self.radius, self.least, self.span, self.children = [], [], [], [], []
        self.longest = float(np.sqrt((rows * rows).sum(axis=1)).max())
        self._build(0, len(rows))

    def _build(self, start: int, end: int) -> int:
        rows = self.rows[start:end]
        centre = rows.mean(axis=0)
        radius = float(np.sqrt(((rows - centre) ** 2).sum(axis=1).max()))
        node = len(self.centre)
        self.centre.append(centre)
        self.radius.append(radius)
        self.least.append(int(self.ids[start:end].min()))
        self.span.append((start, end))
        self.children.append(None)
        if end - start <= LEAF or (rows == rows[0]).all():
            order = np.argsort(self.ids[start:end], kind="stable")
            self._reorder(start, end, order)
            return node
        far = rows[((rows - centre) ** 2).sum(axis=1).argmax()]
        other = rows[((rows - far) ** 2).sum(axis=1).argmax()]
        along = rows @ (other - far)
        order = np.argsort(along, kind="stable")
        middle = self._middle(along[order])
        self._reorder(start, end, order)
        left = self._build(start, start + middle)
        self.children[node] = (left, self._build(start + middle, end))
        return node

    @staticmethod
    def _middle(along: np.ndarray) -> int:
        """The change of value nearest to the middle, so that equal rows stay together."""
        cuts = np.flatnonzero(along[1:] != along[:-1]) + 1
        half = len(along) // 2
        return int(cuts[np.abs(cuts - half).argmin()]) if len(cuts) else half

    def _reorder(self, start: int, end: int, order: np.ndarray) -> None:
        self.rows[start:end] = self.rows[start:end][order]
        self.ids[start:end] = self.ids[start:end][order]

    def _bound(self, node: int, query: np.ndarray, norm: float) -> float:
        bound = float(self.centre[node] @ query) + norm * self.radius[node]
        return bound + 1e-9 * norm * (self.longest + 1) + 1e-6

    def _scores(self, start: int, end: int, query: np.ndarray, norm: float) -> list[int]:
        if norm * self.longest < EXACT:
            return (self.rows[start:end] @ query).astype(np.int64).tolist()
        wide = [int(x) for x in query]
        exact = (sum(int(a) * b for a, b in zip(row, wide)) for row in self.rows[start:end])
        return [min(max(score, LOWEST), HIGHEST) for score in exact]

    def search(self, query: np.ndarray, own: int, k: int, least: tuple | None) -> list[tuple[int, int]]:
        """(score, -id) of the k best rows; only those above ``least``, if that is given."""
        norm = float(np.sqrt(query @ query))
        found: list[tuple[int, int]] = []
        worst = least
        waiting = [(-self._bound(0, query, norm), 0)]
        while waiting:
            bound, node = heapq.heappop(waiting)
            if worst is not None and -bound < worst[0]:
                break
            if worst is not None and np.floor(-bound) == worst[0] and -self.least[node] <= worst[1]:
                continue
            if self.children[node] is not None:
                for child in self.children[node]:
                    heapq.heappush(waiting, (-self._bound(child, query, norm), child))
                continue
            start, end = self.span[node]
            if self.radius[node] == 0:
                end = min(end, start + k + int((self.ids[start:end] == own).sum()))
            for score, vec_id in zip(self._scores(start, end, query, norm), self.ids[start:end].tolist()):
                if vec_id == own or (worst is not None and (score, -vec_id) < worst):
                    continue
                heapq.heappush(found, (score, -vec_id))
                if len(found) > k:
                    heapq.heappop(found)
                if len(found) == k and (worst is None or found[0] > worst):
                    worst = found[0]
        return found


NO_ID = HIGHEST


def _search(rows: DataFrame, k: int, scale: float) -> DataFrame:
    """``rows``: shard, query, vec_id, vector, least_score, least_id; candidates have no query."""

    def scaled(column: pa.Array) -> list[np.ndarray]:
        flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(float))
        cuts = np.cumsum([0, *(len(v) for v in column)])
        return [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, trees = None, {}, None
        for batch in batches:
            vectors = scaled(batch.column(3))
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)]
            out = []
            for place, query, vec_id, score, least_id, vector in zip(*columns, vectors):
                if place != shard:
                    shard, held, trees = place, {}, None
                if query is None:
                    held.setdefault(len(vector), []).append((NO_ID if vec_id is None else vec_id, vector))
                    continue
                if trees is None:
                    trees = {n: BallTree(np.array([v for _, v in some]), np.array([i for i, _ in some]))
                             for n, some in held.items()}
                    held = {}
                tree = trees.get(len(vector))
                if tree is None:
                    continue
                least = None if score is None else (score, -(NO_ID if least_id is None else least_id))
                out += [(query, vec_id, -i, s) for s, i in tree.search(vector, vec_id, k, least)]
            query, asked, found, scores = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(query, pa.int64()),
                    pa.array(asked, pa.int64()),
                    pa.array([None if i == NO_ID else i for i in found], pa.int64()),
                    pa.array(scores, pa.int64()),
                ],
                ["query", "query_id", "vec_id", "score"],
            )

    placed = rows.repartition("shard").sortWithinPartitions("shard", F.col("query").isNotNull())
    return placed.mapInArrow(search, "query long, query_id long, vec_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vector: str = "embedding",
    scale: float = SCALE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best rows for each row with ``is_query``.

    ``is_query`` is a condition on ``vec_id``.
    """
    rows = common.take(vectors, "vec_id", vector).toDF("vec_id", "vector").where(usable(F.col("vector")))
    numbered = rows.withColumn("number", F.monotonically_increasing_id())
    shards = F.lit(max(1, -(-rows.count() // shard_rows)))
    rows = store.materialise(
        numbered.withColumn("shard", F.pmod(F.xxhash64("number"), shards).cast("int")), "vectors"
    )
    none = F.lit(None).cast("long")
    candidates = rows.select(
        "shard", none.alias("query"), "vec_id", "vector",
        none.alias("least_score"), none.alias("least_id"),
    )
    queries = rows.where(F.coalesce(is_query, F.lit(False)) & F.col("vec_id").isNotNull())
    queries = queries.withColumnRenamed("number", "query").withColumnRenamed("shard", "home")
    at_home = queries.select(
        F.col("home").alias("shard"), "query", "vec_id", "vector",
        none.alias("least_score"), none.alias("least_id"),
    )
    first = store.materialise(_search(candidates.unionByName(at_home), k, scale), "first-results")
    least = _ranked(first, k).where(F.col("rank") == k)
    least = least.select("query", F.col("score").alias("least_score"), F.col("vec_id").alias("least_id"))
    away = queries.join(least, "query", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), shards - 1)))
    away = away.where("shard != home").select(*candidates.columns)
    found = first.unionByName(_search(candidates.unionByName(away), k, scale))
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
