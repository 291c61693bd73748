"""Exact search for the largest inner products with two cover trees.

Queries and data are indexed alike: a node has a centre and the radius that covers all below it, and
each child covers its points within a fraction of that radius around centres which are further apart
than it. A pair of nodes is left out when its largest possible product, the product of the centres
plus what both radii can add, is below the worst k-th score of the queries in the group.

Vectors are cut into blocks by a hash of their row, queries too; each pair of blocks is one task of
bounded size, and each query brings home k rows per block. Scores are integers: components are
``floor(1024 * x)``, so results are exact and ties go to the smaller id.

Defined results: vectors that are null or hold a null or non-finite component take no part, nor do
null ids; rows that repeat an id are rows like others, each a candidate of all but itself; vectors of
different lengths are not compared; equal vectors tie; an empty table gives an empty result. Scores
beyond 64 bits are not defined. Only the id and vector columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from noticeloom.llm.common import stored

SCALE = 1024
K = 10
EVERY = 100  # rows whose id it divides are queries
BLOCK_ROWS = 4096
SHRINK = 1.3  # a child's covering radius is its parent's divided by this
LEAF = 64


class Node:
    __slots__ = ("centre", "norm", "radius", "children", "points")

    def __init__(self, centre, radius, children, points):
        self.centre, self.radius, self.children, self.points = centre, radius, children, points
        self.norm = float(np.sqrt(centre @ centre))


def cover_tree(vectors: np.ndarray, points: np.ndarray, at: int, away: np.ndarray) -> Node:
    """The tree over ``points`` (rows of ``vectors``) around row ``at``; ``away`` are their distances to it.

    A node whose children would mostly be single points is a leaf, as are few or equal points.
    """
    radius = float(away.max())
    reach = radius / SHRINK
    if len(points) > LEAF and radius > 0:
        near = away <= reach
        groups = [(at, points[near], away[near])]
        rest, room = points[~near], len(points) // 8
        while len(rest) and len(groups) <= room:
            gap = np.sqrt(((vectors[rest] - vectors[rest[0]]) ** 2).sum(axis=1))
            close = gap <= reach
            groups.append((int(rest[0]), rest[close], gap[close]))
            rest = rest[~close]
        if not len(rest):
            return Node(vectors[at], radius, [cover_tree(vectors, p, a, d) for a, p, d in groups if len(p)], points)
    return Node(vectors[at], radius, None, points)


def tree_of(vectors: np.ndarray) -> Node:
    return cover_tree(vectors, np.arange(len(vectors)), 0, np.sqrt(((vectors - vectors[0]) ** 2).sum(axis=1)))


class DualSearch:
    """The k best of ``data`` for each of ``queries``, both integer matrices with row numbers; ids settle ties."""

    def __init__(self, query_rows, queries, rows, ids, data, k: int):
        self.query_rows, self.rows, self.ids, self.k = query_rows, rows, ids, k
        top = max(int(np.abs(queries).max(initial=0)), int(np.abs(data).max(initial=0)))
        exact = top * top * max(1, data.shape[1]) < 2**53
        self.queries, self.data = (queries.astype(np.float64), data.astype(np.float64)) if exact else (queries, data)
        self.worst = np.full(len(queries), -np.inf)
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(queries)  # scores, ids
        self.visit(tree_of(queries.astype(np.float64)), tree_of(data.astype(np.float64)))

    @staticmethod
    def bound(q: Node, r: Node) -> float:
        most = q.centre @ r.centre + q.radius * r.norm + r.radius * q.norm + q.radius * r.radius
        return most + 1e-9 * (q.norm + q.radius) * (r.norm + r.radius) + 1e-6

    def visit(self, q: Node, r: Node) -> None:
        pairs = [(self.bound(q, r), 0, q, r)]
        while pairs:
            most, _, q, r = pairs.pop()
            if most < self.worst[q.points].min():
                continue
            if q.children is None and r.children is None:
                self.compare(q.points, r.points)
            elif r.children is None or (q.children is not None and q.radius > r.radius):
                pairs += [(self.bound(c, r), i, c, r) for i, c in enumerate(q.children)]
            else:  # the most promising child is looked at first
                pairs += sorted(((self.bound(q, c), i, q, c) for i, c in enumerate(r.children)), key=lambda x: x[:2])

    def compare(self, some: np.ndarray, points: np.ndarray) -> None:
        scores = self.queries[some] @ self.data[points].T
        ids, own = self.ids[points], self.rows[points]
        for i, row in zip(some.tolist(), scores):
            hits = np.flatnonzero((row >= self.worst[i]) & (own != self.query_rows[i]))
            if len(hits) > self.k:
                cut = np.partition(row[hits], len(hits) - self.k)[len(hits) - self.k]
                hits = hits[row[hits] >= cut]
            if len(hits):
                s = np.concatenate([self.best[i][0], row[hits].astype(np.int64)])
                v = np.concatenate([self.best[i][1], ids[hits]])
                order = np.lexsort((v, -s))[: self.k]
                self.best[i] = s[order], v[order]
                if len(order) == self.k:
                    self.worst[i] = s[order[-1]]


def _few_of_equal(ids: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """Of equal vectors the places of the ``most`` smallest ids: the others tie with them and come later."""
    _, group = np.unique(vectors, axis=0, return_inverse=True)
    group = group.reshape(-1)
    order = np.lexsort((ids, group))
    starts = np.flatnonzero(np.r_[True, group[order][1:] != group[order][:-1]])
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[place < most]


def quantised(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, v`` with integer components."""
    x = F.col(vector_col)
    sound = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) != float("inf")))
    ints = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return df.filter(x.isNotNull() & F.col(id_col).isNotNull() & sound).select(F.col(id_col).cast("long").alias("id"), ints.alias("v"))


def top_k(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY, scale: int = SCALE, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per query ``query_id, rank, vec_id, score`` of its k largest products with other rows."""
    numbered = quantised(df, id_col, vector_col, scale).withColumn("row", F.monotonically_increasing_id())
    vectors = stored(numbered, "topk-vectors").withColumn("dim", F.size("v"))
    asked = vectors.filter(F.col("id") % every == 0)
    n, n_asked = vectors.agg(F.count("*"), F.count(F.when(F.col("id") % every == 0, 1))).first()
    blocks, turns = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_asked / block_rows))

    def dealt(rows: DataFrame, own: str, own_n: int, other: str, other_n: int) -> DataFrame:
        own_block = F.pmod(F.xxhash64("row", F.lit(own)), F.lit(own_n).cast("long"))
        return rows.withColumn(own, own_block).withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other_n - 1).cast("long"))))

    def search(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        found = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(data):
            queries = queries.sort_values("row")
            wanted = np.array(queries["v"].tolist(), np.int64).reshape(len(queries), -1)
            ids, rows = data["id"].to_numpy(), np.array(data["v"].tolist(), np.int64).reshape(len(data), -1)
            few = _few_of_equal(ids, rows, k + 1)
            done = DualSearch(queries["row"].to_numpy(), wanted, data["row"].to_numpy()[few], ids[few], rows[few], k)
            for row, q, (scores, hits) in zip(queries["row"].tolist(), queries["id"].tolist(), done.best):
                found["query_row"] += [row] * len(hits)
                found["query_id"] += [q] * len(hits)
                found["vec_id"] += hits.tolist()
                found["score"] += scores.tolist()
        return pd.DataFrame(found).astype("int64")

    keys = ["dim", "block", "turn"]
    left = dealt(asked, "turn", turns, "block", blocks).groupBy(*keys)
    # Columns of their own: a cogroup of a table with itself takes the left side's for both.
    right = dealt(vectors.select(*[F.col(c).alias(c) for c in vectors.columns]), "block", blocks, "turn", turns).groupBy(*keys)
    found = left.cogroup(right).applyInPandas(search, "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
