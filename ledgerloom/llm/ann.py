"""Nearest neighbours by largest inner product, through low-dimensional stable projections.

Vectors get one more coordinate that gives all of them the length of the longest, so the largest
inner product with a query is the smallest distance to it. Distances are projected to ``width``
dimensions by Gaussian vectors (the 2-stable law): a projected squared distance divided by the true
one follows a chi-square law. Each shard of the index is a kd-tree over projected vectors. A query
takes leaves in the order of their projected distance and verifies the vectors in them, until the
next leaf is so far that a vector nearer than the ``k``-th found would have been met already with
chance ``certainty``.

Every row is in one shard; blocks of queries meet shards in separate groups, so neither all rows nor
all queries ever meet in one task.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

RESULT = "query_id long, vec_id long, score double"


def chi_square_quantile(certainty: float, width: int) -> float:
    """Value that a chi-square variable of an even number of degrees stays below with that chance."""
    low, high = 0.0, 1000.0
    for _ in range(100):
        x = (low + high) / 2
        term = total = 1.0
        for i in range(1, width // 2):
            term *= x / 2 / i
            total += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < certainty else (low, x)
    return high


def projection(dims: int, width: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).normal(size=(dims + 1, width))


class Tree:
    """kd-tree over projected points: leaves as ranges of ``order`` with their boxes."""

    def __init__(self, points: np.ndarray, leaf: int = 32):
        self.order = np.arange(len(points))
        cuts, stack = [], [(0, len(points))]
        while stack:
            a, b = stack.pop()
            if b - a <= leaf:
                cuts.append((a, b))
                continue
            held = points[self.order[a:b]]
            axis = int((held.max(axis=0) - held.min(axis=0)).argmax())
            middle = (b - a) // 2
            self.order[a:b] = self.order[a:b][np.argpartition(held[:, axis], middle)]
            stack += [(a, a + middle), (a + middle, b)]
        self.cuts = sorted(c for c in cuts if c[1] > c[0])
        self.low = np.array([points[self.order[a:b]].min(axis=0) for a, b in self.cuts])
        self.high = np.array([points[self.order[a:b]].max(axis=0) for a, b in self.cuts])

    def distances(self, query: np.ndarray) -> np.ndarray:
        """Least squared distance from the query to each leaf's box."""
        gap = np.maximum(np.maximum(self.low - query, query - self.high), 0)
        return (gap * gap).sum(axis=1)


def search(names: np.ndarray, vectors: np.ndarray, query_names: np.ndarray, queries: np.ndarray, k: int, longest: float,
           width: int, certainty: float, seed: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Each query with the names and inner products of its ``k`` nearest vectors found."""
    turn = projection(vectors.shape[1], width, seed)
    rest = np.sqrt(np.maximum(longest ** 2 - (vectors ** 2).sum(axis=1), 0))
    tree = Tree(np.column_stack([vectors, rest]) @ turn)
    vectors, names = vectors[tree.order], names[tree.order]
    bound = chi_square_quantile(certainty, width)
    for name, query in zip(query_names.tolist(), queries):
        far = tree.distances(query @ turn[:-1])
        order = np.argsort(far, kind="stable")
        base = float(query @ query) + longest ** 2
        rows, scores = np.empty(0, np.int64), np.empty(0)
        done, step = 0, 8
        while done < len(order):
            here = np.concatenate([np.arange(*tree.cuts[i]) for i in order[done:done + step]])
            here = here[names[here] != name]
            rows, scores = np.concatenate([rows, here]), np.concatenate([scores, vectors[here] @ query])
            done, step = done + step, step * 2
            if len(scores) > k:
                # products that rounding may put at the k-th place are kept for the exact order below
                least = np.partition(scores, len(scores) - k)[len(scores) - k]
                near = scores >= least - 1e-9 * base
                rows, scores = rows[near], scores[near]
            if len(scores) >= k and done < len(order) and far[order[done]] > bound * max(base - 2 * scores.min(), 0) + 1e-9 * base:
                break
        exact = (vectors[rows] * query).sum(axis=1)
        best = np.lexsort((names[rows], -exact))[:k]
        yield name, names[rows][best], exact[best]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    flat = column.combine_chunks().flatten()
    return np.asarray(flat, np.float64).reshape(-1, dims)


def _meet(dims: int, k: int, longest: float, width: int, certainty: float, seed: int):
    def run(index: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if index.num_rows and asked.num_rows:
            for name, found, scores in search(np.asarray(index["vec_id"]), _matrix(index["vector"], dims), np.asarray(asked["vec_id"]),
                                              _matrix(asked["vector"], dims), k, longest, width, certainty, seed):
                out["query_id"] += [name] * len(found)
                out["vec_id"] += found.tolist()
                out["score"] += scores.tolist()
        return pa.table(out, schema=pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]))
    return run


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, width: int = 8, certainty: float = 0.98,
            shard: int = 1 << 14, block: int = 1 << 12, seed: int = 11) -> DataFrame:
    """The ``k`` vectors of largest inner product found for each query, nearest first.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all other rows.
    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the inner product of the original vectors in double
    precision; ties go to the smaller ``vec_id``. With fewer than ``k`` candidates all are returned.

    Rows with a null ``vec_id`` or whose vector is null, empty, zero, of another length than most,
    or holds a null or non-finite component take no part. Rows that share a ``vec_id`` count as one vector's
    copies: none is found for a query of that id. An empty table gives an empty result.
    """
    component = F.col("vector")
    finite = F.forall(component, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    square = F.aggregate(component, F.lit(0.0), lambda a, x: a + x * x)
    usable = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")) \
        .where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(finite).where(F.exists("vector", lambda x: x != 0))
    sizes = usable.groupBy(F.size("vector").alias("dims")).agg(F.count("*").alias("n"), F.max(square).alias("square")).orderBy(F.desc("n"), "dims").first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    usable = usable.where(F.size("vector") == sizes.dims)
    shards, blocks = -(-sizes.n // shard), -(-sizes.n // (every * block))
    index = usable.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = usable.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"]).withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")) \
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    met = index.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")) \
        .applyInArrow(_meet(sizes.dims, k, math.sqrt(sizes.square), width, certainty, seed), RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
