"""Approximate nearest neighbours by collision counting (operator 2).

Rows are dealt by hash into blocks of about ``DATA_BLOCK`` vectors, and queries
into blocks of about ``QUERY_BLOCK``; every pair of blocks is one task's work, so
neither side is ever whole in one place.  In a data block the unit vectors are
projected on ``LINES`` random lines, and each projection is a sorted array.  A
query opens a window around its own projection in every array, of half-width
R * W / 2, and counts for each vector in how many windows it lies.  Virtual
rehashing widens the same windows step by step, so only what a step adds is
counted.  A vector whose count reaches the collision threshold is verified by
its exact cosine.  The search ends when the k-th best distance is at most R: a
vector nearer than that lies in a window with probability P1 or more and has
reached the threshold but for a tail of ``SIGMAS`` standard deviations (about 1
in 100).  There is no cap on candidates.  The blocks' results are merged by rank.

Cases: vectors that are null, empty, all zero or that hold a null or non-finite
component take no part; vectors meet vectors of their own length only; equal
vectors have equal scores, ties going to the smaller id; rows that share a
query's id are not its candidates, and rows that share an id as queries are one
query (the smallest vector); null ids are candidates of nobody; with fewer than
k candidates all are returned; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldops.llm.common import read

LINES = 64
W = 2.7
P1 = math.erf(W / 2 / math.sqrt(2))  # a window of half-width R * W / 2 holds a vector at distance R
SIGMAS = 2.4
THRESHOLD = math.ceil(LINES * P1 - SIGMAS * math.sqrt(LINES * P1 * (1 - P1)))
STEP = 1.2
DATA_BLOCK, QUERY_BLOCK = 8192, 512
SEED = 2


class Block:
    """The sorted projections of a block of vectors (rows of ``x``), one array
    after the other: line j holds positions j * n to (j + 1) * n."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, lines: np.ndarray):
        by_id = np.argsort(ids, kind="stable")
        self.ids, self.x = ids[by_id], x[by_id]
        self.norm = np.sqrt((self.x * self.x).sum(axis=1))
        p = ((self.x / self.norm[:, None]) @ lines).T
        order = np.argsort(p, axis=1, kind="stable")
        self.far = 4.0 * float(np.abs(lines).sum(axis=0).max()) + 1  # keeps the lines' values apart in one array
        self.shift = np.arange(len(p)) * self.far
        self.order = order.astype(np.int32).ravel()
        self.sorted = (np.take_along_axis(p, order, axis=1) + self.shift[:, None]).ravel()

    def nearest(self, own: int, q: np.ndarray, lines: np.ndarray, k: int) -> list[tuple[float, int]]:
        """(score, id) of the k nearest that the search finds, nearest first."""
        n, m = len(self.ids), len(self.shift)
        q_norm = math.sqrt(float((q * q).sum()))
        at = (q / q_norm) @ lines + self.shift
        first, last = np.arange(m) * n, np.arange(1, m + 1) * n
        other = self.ids != own
        total = int(other.sum())
        counts = np.zeros(n, dtype=np.int64)
        lo = np.clip(np.searchsorted(self.sorted, at), first, last)
        hi = lo.copy()
        new = other.copy()
        scores = np.full(n, -np.inf)
        some = self.x[:: max(1, n // 64)] / self.norm[:: max(1, n // 64), None]
        radius = 0.3 * float(np.median(np.sqrt(((some - q / q_norm) ** 2).sum(axis=1)))) or math.inf
        while total:
            if radius > 10:  # beyond any window of unit vectors: all are in
                radius = math.inf
            half = radius * W / 2
            a = np.maximum(np.searchsorted(self.sorted, at - half, side="left"), first) if half < self.far / 4 else first
            b = np.minimum(np.searchsorted(self.sorted, at + half, side="right"), last) if half < self.far / 4 else last
            begin, size = np.concatenate([a, hi]), np.concatenate([lo - a, b - hi])  # what this step adds
            if size.sum():
                place = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
                counts += np.bincount(self.order[place], minlength=n)
            lo, hi = a, b
            found = np.flatnonzero((counts >= THRESHOLD) & new)
            if len(found):
                new[found] = False
                scores[found] = (self.x[found] * q).sum(axis=1) / (self.norm[found] * q_norm)
            ready = np.flatnonzero(scores > -np.inf)
            kth = math.inf
            if len(ready) >= k:
                kth = math.sqrt(max(0.0, 2 - 2 * np.partition(scores[ready], len(ready) - k)[len(ready) - k]))
            if len(ready) == total or kth <= radius * (1 + 1e-9):
                best = ready[scores[ready] >= np.sort(scores[ready])[::-1][min(k, len(ready)) - 1]]
                best = best[np.lexsort((self.ids[best], -scores[best]))[:k]]
                return [(float(scores[i]), int(self.ids[i])) for i in best]
            radius = min(radius * STEP, max(kth, radius * 1.0001))
        return []


def _search(k: int):
    def run(key: tuple, data: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[int, float, int]] = []
        if data.num_rows and queries.num_rows:
            dim = key[2].as_py()
            lines = np.random.default_rng(SEED).standard_normal((dim, LINES))
            matrix = lambda t: t.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
            block = Block(data.column("id").to_numpy(), matrix(data), lines)
            for own, q in zip(queries.column("id").to_pylist(), matrix(queries), strict=True):
                out += [(own, s, i) for s, i in block.nearest(own, q, lines, k)]
        return pa.table([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.float64()), pa.array([o[2] for o in out], pa.int64())],
                        names=["query_id", "score", "vec_id"])
    return run


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): of every row for which ``is_query`` holds."""
    v = F.col("v")
    usable = (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("v"), is_query.alias("asks")).where(
        F.col("id").isNotNull() & v.isNotNull()).where(usable).withColumn("dim", F.size("v"))
    n = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q")).first()
    data_blocks, query_blocks = max(1, -(-n["n"] // DATA_BLOCK)), max(1, -(-n["q"] // QUERY_BLOCK))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    place = lambda salt, count: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(count)).cast("int")
    # Rows with one id spread over the blocks with it; a hot id needs its vector in the hash too.
    data = rows.select("id", "v", "dim", F.pmod(F.xxhash64("id", "v"), F.lit(data_blocks)).cast("int").alias("d"), every(query_blocks).alias("q"))
    asking = rows.where("asks").groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    asking = asking.select("id", "v", "dim", every(data_blocks).alias("d"), place(1, query_blocks).alias("q"))
    found = (data.groupBy("d", "q", "dim").cogroup(asking.groupBy("d", "q", "dim"))
             .applyInArrow(_search(k), "query_id long, score double, vec_id long"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_collision_ann(spark, sf_dir: str) -> DataFrame:
    return nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
