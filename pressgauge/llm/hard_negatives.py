"""Hard negatives by Fagin's threshold algorithm.

Every shard keeps its rows once per dimension in the order of that component. For an anchor each of these
lists is read from its high or its low end, by the sign of the anchor's component; every row met is then
scored exactly by random access. The components last read give the highest score that an unseen row can
still have. Reading stops once that threshold falls strictly below the kth score of each window, or below
its lower end. Positives are the one open window of the anchor's label; each positive then opens a window
of scores for the other labels.

Edge cases: see ``vectors.usable`` (null ids and vectors, non-finite components, repeated ids); null labels
take no part; ties go to the smaller id; fewer rows than asked for give all of them; an anchor of zeros
scores every row 0; a negative positive score gives an empty window; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pressgauge.llm.vectors import Grid, exact, ids, matrix, prepared, usable

FIRST_READ = 16


class SortedLists:
    """One list of the rows per dimension, ascending by component; rows are in order of their ids."""

    def __init__(self, rows: np.ndarray) -> None:
        self.rows = rows
        self.order = np.argsort(rows, axis=0, kind="stable")
        self.values = np.take_along_axis(rows, self.order, 0)
        self.scored = 0

    def search(self, anchor: np.ndarray, accept: np.ndarray, windows: list[tuple[float, float]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(rows, scores) of the best k accepted rows inside each window (low, high), ends included."""
        n = len(self.rows)
        up, down = np.flatnonzero(anchor > 0), np.flatnonzero(anchor < 0)
        best = [(np.zeros(0, np.int64), np.zeros(0, self.rows.dtype)) for _ in windows]
        seen = np.zeros(n, bool)
        at, step = 0, FIRST_READ
        while at < n:
            end = min(n, at + step)
            if len(up) or len(down):
                met = np.concatenate((self.order[n - end: n - at, up].ravel(), self.order[at:end, down].ravel()))
            else:
                end, met = n, np.arange(n)
            fresh = np.zeros(n, bool)
            fresh[met] = True
            fresh &= ~seen
            seen |= fresh
            new = np.flatnonzero(fresh)
            score = self.rows[new] @ anchor
            self.scored += len(new)
            threshold = (self.values[n - end, up] * anchor[up]).sum() + (self.values[end - 1, down] * anchor[down]).sum()
            done = True
            for i, (low, high) in enumerate(windows):
                inside = accept[new] & (score >= low) & (score <= high)
                row = np.concatenate((best[i][0], new[inside]))
                value = np.concatenate((best[i][1], score[inside]))
                order = np.lexsort((row, -value))[:k]
                best[i] = row[order], value[order]
                least = max(low, value[order][-1]) if len(order) == k else low
                done &= bool(threshold < least)
            if done:
                break
            at, step = end, 2 * step
        return best


def _lists(left: pa.Table, right: pa.Table, width: int):
    """The rows' ids and labels in order of the ids, their lists, and the anchors."""
    row_ids = ids(left)
    order = np.argsort(row_ids, kind="stable")
    rows, anchors = exact(matrix(left, width)[order], matrix(right, width))
    return row_ids[order], ids(left, "label")[order], SortedLists(rows), anchors


def _positives(k: int, width: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(3)]
        if left.num_rows and right.num_rows:
            row_ids, labels, lists, anchors = _lists(left, right, width)
            for anchor_id, label, anchor in zip(ids(right), ids(right, "label"), anchors):
                accept = (labels == label) & (row_ids != anchor_id)
                if accept.any():
                    [(row, score)] = lists.search(anchor, accept, [(-np.inf, np.inf)], k)
                    for column, own in zip(out, (np.full(len(row), anchor_id), row_ids[row], score.astype(np.int64))):
                        column.append(own)
        return pa.table([np.concatenate(x) for x in out], names=["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(k: int, width: int, lowest: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [[np.zeros(0, np.int64)] for _ in range(5)]
        if left.num_rows and right.num_rows:
            row_ids, labels, lists, anchors = _lists(left, right, width)
            for anchor_id, label, anchor, positives in zip(ids(right), ids(right, "label"), anchors, right.column("positives").to_pylist()):
                # The least integer of which 100 times reaches the share of the positive score.
                windows = [(-(-lowest * p["positive_score"] // 100), p["positive_score"]) for p in positives]
                found = lists.search(anchor, labels != label, windows, k)
                for p, (row, score) in zip(positives, found):
                    n = len(row)
                    own = (np.full(n, anchor_id), np.full(n, p["positive_id"]), np.full(n, p["positive_score"]), row_ids[row], score.astype(np.int64))
                    for column, values in zip(out, own):
                        column.append(values)
        names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        return pa.table([np.concatenate(x).astype(np.int64) for x in out], names=names)

    return run


def _first(found: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), row)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    df: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, lowest: int = 80, label: Column | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each anchor (a condition over ``vec_id``) and each of its ``positives`` best rows of the same label:
    the ``negatives`` best rows of another label scoring between ``lowest`` percent of the positive and all
    of it. ``label`` is an integer expression over the columns of ``df``.
    """
    kind = (F.col("label") if label is None else label).cast("long").alias("label")
    rows = prepared(usable(df.where(kind.isNotNull()), id_col, vector_col, kind))
    anchors = rows.where(is_anchor)
    grid = Grid(rows, anchors)
    near = grid.cells(rows, anchors, _positives(positives, grid.width), "anchor_id long, positive_id long, positive_score long")
    chosen = prepared(_first(near, ["anchor_id"], "positive_score", "positive_id", positives))
    # At most ``positives`` entries for each anchor.
    lists = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    asked = anchors.join(lists.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    schema = "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = grid.cells(rows, asked, _negatives(negatives, grid.width, lowest), schema)
    best = _first(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return best.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
