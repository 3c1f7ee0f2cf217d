"""Nearest neighbours with vantage-point trees per shard (operator 7).

Vectors are dealt to shards by the hash of their id, queries in blocks to every
shard.  The task of a (shard, block of queries) builds a vantage-point tree over
the shard and searches it for all queries of the block at once.  A subtree whose
distance bound, by the triangle inequality, is above ``factor`` times the
current k-th distance is skipped: factor 1 is exact, a smaller factor skips
more and may lose neighbours.  Memory is bounded by a shard and a block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOUND = "query_id bigint, vec_id bigint, score double"


class VantageTree:
    """Nodes are slices of ``order``: the first point of a slice is its vantage point, the points
    within its median distance come next, the others last; slices of ``leaf`` points or less are not cut."""

    def __init__(self, points: np.ndarray, leaf: int = 64):
        self.points, self.leaf = points, leaf
        self.order = np.arange(len(points))
        self.cut: dict[tuple[int, int], tuple[int, float]] = {}   # slice -> (start of the outer part, median)
        todo = [(0, len(points))]
        while todo:
            lo, hi = todo.pop()
            if hi - lo <= leaf:
                continue
            part = self.order[lo:hi]
            spread = np.linalg.norm(points[part] - points[part].mean(axis=0), axis=1)
            far = int(spread.argmax())                            # a point at the rim divides best
            part[[0, far]] = part[[far, 0]]
            d = distances(points[part[1:]], points[part[0]])
            rank = np.argsort(d, kind="stable")
            self.order[lo + 1:hi] = part[1:][rank]
            d = d[rank]
            half = len(d) // 2
            self.cut[lo, hi] = (lo + 1 + half, float(d[half]))
            todo += [(lo + 1, lo + 1 + half), (lo + 1 + half, hi)]

    def search(self, queries: np.ndarray, own: np.ndarray, ids: np.ndarray, k: int, factor: float):
        """(distances, positions) of the k nearest points of each query, by distance and position; no point
        with the query's own id.  Missing neighbours are inf.  ``self.looked`` counts distances computed."""
        best = np.full((len(queries), k), np.inf)
        best_at = np.full((len(queries), k), len(self.points))
        self.looked = 0

        def offer(rows: np.ndarray, members: np.ndarray, d: np.ndarray) -> None:
            d = np.where(ids[members][None, :] == own[rows][:, None], np.inf, d)
            every = np.concatenate([best[rows], d], axis=1)
            places = np.concatenate([best_at[rows], np.broadcast_to(members, d.shape)], axis=1)
            first = np.lexsort((places, every), axis=1)[:, :k]
            best[rows] = np.take_along_axis(every, first, axis=1)
            best_at[rows] = np.take_along_axis(places, first, axis=1)

        everyone = np.arange(len(queries))
        todo = [(0, len(self.points), everyone, np.zeros(len(queries)))]
        while todo:
            lo, hi, rows, bound = todo.pop()
            rows = rows[bound <= factor * best[rows, -1] * (1 + 1e-9)]
            if not len(rows) or lo == hi:
                continue
            if (lo, hi) not in self.cut:
                members = self.order[lo:hi]
                for at in range(0, len(rows), 512):
                    some = rows[at:at + 512]
                    d = distances(queries[some][:, None, :], self.points[members][None, :, :])
                    self.looked += d.size
                    offer(some, members, d)
                continue
            middle, median = self.cut[lo, hi]
            vantage = self.order[lo:lo + 1]
            d = distances(queries[rows], self.points[vantage[0]])
            self.looked += d.size
            offer(rows, vantage, d[:, None])
            inside, gap = d < median, np.abs(d - median)
            for side, a, b in ((~inside, lo + 1, middle), (inside, middle, hi)):   # the far parts, for later
                todo.append((a, b, rows[side], gap[side]))
            for side, a, b in ((inside, lo + 1, middle), (~inside, middle, hi)):
                todo.append((a, b, rows[side], np.zeros(int(side.sum()))))
        return best, best_at


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(axis=-1))


def exact_score(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distance with the squares added from first to last component, as a plain loop does."""
    return np.sqrt(np.cumsum((a - b) ** 2, axis=-1)[..., -1])


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
            factor: float = 1.0, shard_rows: int = 2048, block_rows: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` nearest rows of each query row of ``df``.

    ``is_query`` is a condition on ``df``.  Vectors that are not usable() and
    rows with a null id take no part; a query meets vectors of its own length
    only.  Rows that share the query's id are its own and no candidates; of
    queries that share an id the least vector counts; other repeated rows are
    candidates of their own.  An empty table gives an empty result.
    """
    rows = df.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    points = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    queries = (rows.where(is_query).select(F.col(id_col).cast("long").alias("query_id"),
                                           F.col(vector_col).cast("array<double>").alias("q"))
               .groupBy("query_id").agg(F.min("q").alias("q")))
    shards = max(1, math.ceil(points.count() / shard_rows))
    blocks = max(1, math.ceil(queries.count() / block_rows))
    dealt = points.select("vec_id", "v", F.size("v").alias("dim"),
                          F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).alias("shard"),
                          F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    asked = queries.select("query_id", "q", F.size("q").alias("dim"),
                           F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
                           F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"))

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "score": "float64"})
        x, q = np.stack(left["v"].to_numpy()), np.stack(right["q"].to_numpy())
        ids, own = left["vec_id"].to_numpy(), right["query_id"].to_numpy()
        order = np.lexsort((*x.T[::-1], ids))                      # position follows id, whatever the order of rows
        x, ids = x[order], ids[order]
        found, at = VantageTree(x).search(q, own, ids, k, factor)
        i, j = np.nonzero(np.isfinite(found))
        near = at[i, j]
        return pd.DataFrame({"query_id": own[i], "vec_id": ids[near], "score": exact_score(q[i], x[near])})

    hits = (dealt.groupBy("shard", "block", "dim").cogroup(asked.groupBy("shard", "block", "dim"))
            .applyInPandas(search, FOUND))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


ORACLE_SQL = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
q AS (SELECT vec_id, min(e) AS e FROM v WHERE vec_id % 100 = 0 GROUP BY vec_id),
d AS (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, v.e),
        lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score
      FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.e) = len(v.e)),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
