"""Exact top-k search by inner product with the threshold algorithm.

Vectors are dealt into blocks by id, queries too; each pair of blocks meets in one task. A block keeps, per dimension,
its vectors sorted by that component. For a query the lists are read from their favourable ends, a step of depth at a
time; the vectors seen are scored in full, and the sum of the query's products with the last values read bounds
every unseen one. Reading ends when that bound is below the kth best score. The best k of each block then compete.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K = 5
SCALE = 256
#: Vectors and queries in a block, on average.
BLOCK, QUERY_BLOCK = 4096, 512
#: How far the lists are read first, and by what factor further each time.
FIRST_DEPTH, DEEPER = 16, 4
#: Below this, sums of products are exact in doubles.
EXACT = 2 ** 53


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v, the components as floor(256 * x); unusable vectors are left out."""
    usable = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                      & (F.abs(x.cast("double")) < float("inf")))
    return vectors.filter(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.coalesce(usable, F.lit(False))) \
        .select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(
            F.col(embedding), lambda x: F.floor(x.cast("double") * SCALE)).alias("v"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out, ends = np.zeros((len(lists), width), np.int64), np.cumsum(sizes)
    for i, (end, size) in enumerate(zip(ends, sizes)):
        out[i, :size] = flat[end - size:end]
    return out


def _width(column: pa.ChunkedArray) -> int:
    return max((len(x) for x in column), default=0)


class SortedLists:
    """A block's vectors with one list per dimension, sorted by component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.exact = ids, vectors
        self.order = np.argsort(vectors, axis=0, kind="stable")
        self.values = np.take_along_axis(vectors, self.order, axis=0)
        self.largest = int(np.abs(vectors).max(initial=0))

    def _typed(self, query: np.ndarray):
        bound = self.largest * int(np.abs(query.astype(object)).max(initial=0)) * len(query)
        return np.float64 if bound < EXACT else object

    def best(self, query_id: int, query: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        """ids and scores of the k best vectors other than the query's own; ties to the smaller id."""
        kind, n = self._typed(query), len(self.ids)
        q = query.astype(kind)
        used = np.flatnonzero(query)
        rising = query[used] < 0  # the favourable end of such a list is its smallest value
        seen, ids, scores = np.zeros(n, bool), np.empty(0, np.int64), np.empty(0, kind)
        depth = FIRST_DEPTH if len(used) else n
        while True:
            depth = min(depth, n)
            before = seen.copy()
            seen[self.order[:depth, used[rising]].ravel()] = True
            seen[self.order[n - depth:, used[~rising]].ravel()] = True
            if depth == n:
                seen[:] = True
            new = np.flatnonzero(seen & ~before)
            new = new[self.ids[new] != query_id]
            ids = np.concatenate([ids, self.ids[new]])
            scores = np.concatenate([scores, self.exact[new].astype(kind) @ q])
            if len(ids) > k:
                top = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[top], scores[top]
            if depth == n or seen.all():
                break
            last = np.where(rising, self.values[depth - 1, used], self.values[n - depth, used])
            if len(ids) == k and min(scores) > (last.astype(kind) * q[used]).sum():
                break
            depth *= DEEPER
        order = np.lexsort((ids, -scores))
        return ids[order].tolist(), [int(x) for x in scores[order]]


SCHEMA = "query_id long, vec_id long, score long"


def _search(k: int):
    def search(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        found: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(vectors) and len(queries):
            width = max(_width(vectors["v"]), _width(queries["v"]))
            block = SortedLists(vectors["vec_id"].to_numpy(), _matrix(vectors["v"], width))
            for query_id, query in zip(queries["vec_id"].to_pylist(), _matrix(queries["v"], width)):
                ids, scores = block.best(query_id, query, k)
                found["query_id"] += [query_id] * len(ids)
                found["vec_id"] += ids
                found["score"] += [max(-2 ** 63, min(2 ** 63 - 1, s)) for s in scores]
        return pa.table({n: pa.array(v, pa.int64()) for n, v in found.items()})
    return search


def _dealt(vec_id: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(vec_id), F.lit(blocks)).cast("int")


def search(vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
           block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other vectors of each query.

    Vectors that are null or hold a null or non-finite component, and rows with a null id, take no part. A shorter vector
    counts as padded by zeros. Components beyond a long stop at its ends, and so do scores. An id given twice is
    one query (its smallest vector) and two candidates, neither of them for itself. is_query is a condition on the
    columns of `vectors`; other columns are not read. A vector of any length is used whole; an empty table, or one without
    queries, gives an empty result. No row pairs are made: a task holds one block of vectors and one of queries.
    """
    candidates = integer_vectors(vectors, vec_id, embedding)
    queries = integer_vectors(vectors.filter(is_query), vec_id, embedding).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = max(1, math.ceil(vectors.count() / block))
    query_blocks = max(1, math.ceil(vectors.filter(is_query).count() / query_block))
    left = candidates.withColumn("b", _dealt(F.col("vec_id"), blocks)) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("qb", _dealt(F.col("vec_id"), query_blocks)) \
        .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = left.groupBy("b", "qb").cogroup(right.groupBy("b", "qb")).applyInArrow(
        lambda x, y: _search(k)(x.select(["vec_id", "v"]), y.select(["vec_id", "v"])), SCHEMA)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
