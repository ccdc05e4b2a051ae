"""Exact top-k inner products by ball trees, one per shard, with branch and bound.

A node bounds the inner product of a query with all its points by that with its centre plus the query's
length times its radius. A query first goes down to the leaf of the best bound, which gives it a kth
score; then it visits the other leaves in the order of their bounds, and leaves out every branch whose
bound lies below the kth score it has by then. The kth scores found in one shard are sent along to all
others, so these begin with a bound. Bounds are doubles with a margin for rounding; scores are integers.

Edge cases: see ``vectors.usable`` (nulls, non-finite components, repeated ids); ties go to the smaller
id; fewer than k other rows give all of them; empty vectors score 0; vectors of different lengths are
filled up with zeros; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgauge.llm.vectors import LOWEST, Grid, exact, ids, matrix, prepared, usable

LEAF = 128
FOUND = "query_id long, vec_id long, score long"


class BallTree:
    """Points halved again and again across the line between two far ones, down to ``LEAF`` points."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points = points
        self.members: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii, waiting = [], [], [(np.arange(len(points)), -1, 0)]
        while waiting:
            own, parent, side = waiting.pop()
            at = len(self.members)
            if parent >= 0:
                pair = self.children[parent] or (0, 0)
                self.children[parent] = (at, pair[1]) if side == 0 else (pair[0], at)
            some = points[own]
            centre = some.mean(axis=0)
            away = np.sqrt(((some - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(away.max())
            self.members.append(own)
            self.children.append(None)
            if len(own) > leaf and radii[-1] > 0:
                one = some[away.argmax()]
                other = some[((some - one) ** 2).sum(axis=1).argmax()]
                order = np.argsort(some @ (other - one), kind="stable")
                half = len(own) // 2
                waiting += [(own[np.sort(order[:half])], at, 0), (own[np.sort(order[half:])], at, 1)]
        self.centres, self.radii = np.array(centres), np.array(radii)
        self.lengths = np.sqrt((self.centres ** 2).sum(axis=1))

    def bound(self, queries: np.ndarray, lengths: np.ndarray, node: int) -> np.ndarray:
        """No point of the node scores more with these queries."""
        reach = lengths * self.radii[node]
        margin = 1e-9 * (lengths * self.lengths[node] + reach) + 1e-6
        return queries @ self.centres[node] + reach + margin


class Search:
    """The best k rows of one shard for several queries; ``kth`` holds the scores that others have reached."""

    def __init__(self, tree: BallTree, row_ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int, kth: np.ndarray) -> None:
        self.tree, self.row_ids, self.query_ids, self.k = tree, row_ids, query_ids, k
        self.queries, self.lengths = queries, np.sqrt((queries ** 2).sum(axis=1))
        self.exact_rows, self.exact_queries = exact(tree.points, queries)
        self.scores = np.full((len(queries), k), LOWEST, self.exact_rows.dtype)
        self.ids = np.zeros((len(queries), k), np.int64)
        self.kth = kth.copy()
        self.scored = 0

    def visit(self, leaf: int, who: np.ndarray) -> None:
        """Score a leaf's points and keep the best; points are in order of their ids, so ties keep the smaller."""
        own = self.tree.members[leaf]
        score = self.exact_queries[who] @ self.exact_rows[own].T
        self.scored += score.size
        score[self.query_ids[who][:, None] == self.row_ids[own][None, :]] = LOWEST
        best = np.argsort(-score, axis=1, kind="stable")[:, : self.k]
        scores = np.concatenate((self.scores[who], np.take_along_axis(score, best, 1)), axis=1)
        found = np.concatenate((self.ids[who], self.row_ids[own][best]), axis=1)
        order = np.lexsort((found, -scores), axis=1)[:, : self.k]
        self.scores[who] = np.take_along_axis(scores, order, 1)
        self.ids[who] = np.take_along_axis(found, order, 1)
        self.kth[who] = np.maximum(self.kth[who], self.scores[who, self.k - 1])

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row id, score) of at most k rows per query, none below the kth score known for it."""
        tree, every = self.tree, np.arange(len(self.queries))
        first = np.zeros(len(every), np.int64)
        waiting = [(0, every)]
        while waiting:
            node, who = waiting.pop()
            pair = tree.children[node]
            if pair is None:
                first[who] = node
                self.visit(node, who)
                continue
            bounds = [tree.bound(self.queries[who], self.lengths[who], child) for child in pair]
            left = bounds[0] >= bounds[1]
            waiting += [(child, who[side]) for child, side in zip(pair, (left, ~left)) if side.any()]
        leaves: list[tuple[int, np.ndarray, np.ndarray]] = []
        waiting = [(0, every)]
        while waiting:
            node, who = waiting.pop()
            for child in tree.children[node] or ():
                bound = tree.bound(self.queries[who], self.lengths[who], child)
                near = bound >= self.kth[who]
                if tree.children[child] is not None and near.any():
                    waiting.append((child, who[near]))
                elif near.any():
                    near &= first[who] != child
                    leaves.append((child, who[near], bound[near]))
        if leaves:
            self._others(*(np.concatenate(x) for x in zip(*((np.full(len(w), leaf), w, b) for leaf, w, b in leaves))))
        query, place = np.nonzero((self.scores > LOWEST) & (self.scores >= self.kth[:, None]))
        return query, self.ids[query, place], self.scores[query, place].astype(np.int64)

    def _others(self, leaf: np.ndarray, who: np.ndarray, bound: np.ndarray) -> None:
        """Visit pairs of leaf and query by descending bound, more of them at a time as fewer are left."""
        order = np.lexsort((-bound, who))
        leaf, who, bound = leaf[order], who[order], bound[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        low, step = 0, 1
        while True:
            now = np.flatnonzero((rank >= low) & (bound >= self.kth[who]))
            if not len(now):
                return
            now = now[rank[now] < low + step]
            now = now[np.argsort(leaf[now], kind="stable")]
            for own in np.split(now, np.flatnonzero(np.diff(leaf[now])) + 1):
                if len(own):
                    self.visit(int(leaf[own[0]]), who[own])
            low, step = low + step, 2 * step


def _search(k: int, width: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row_ids = ids(left)
        order = np.argsort(row_ids, kind="stable")
        rows, queries = matrix(left, width)[order], matrix(right, width)
        out = [np.zeros(0, np.int64)] * 3
        if len(rows) and len(queries):
            query_ids = ids(right)
            known = np.asarray(right.column("kth").combine_chunks()) if "kth" in right.column_names else np.full(len(queries), LOWEST)
            query, row, score = Search(BallTree(rows), row_ids[order], queries, query_ids, k, known.astype(np.int64)).run()
            out = [query_ids[query], row, score]
        return pa.table(out, names=["query_id", "vec_id", "score"])

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(df: DataFrame, is_query: Column, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k other rows of highest integer inner product with each query.

    ``is_query`` is a condition over ``vec_id``.
    """
    rows = prepared(usable(df, id_col, vector_col))
    queries = rows.where(is_query)
    grid = Grid(rows, queries)
    own = F.col("shard") == F.pmod("part", F.lit(grid.shards))
    seeds = grid.cells(rows, queries, _search(k, grid.width), FOUND, own)
    if grid.shards == 1:
        return _best(seeds, k).select("query_id", "rank", "vec_id", "score")
    seeds = prepared(seeds)
    reached = seeds.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))
    bounded = queries.join(reached.withColumnRenamed("query_id", "vec_id"), "vec_id", "left").withColumn("kth", F.coalesce("kth", F.lit(LOWEST)))
    rest = grid.cells(rows, bounded, _search(k, grid.width), FOUND, ~own)
    return _best(seeds.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
