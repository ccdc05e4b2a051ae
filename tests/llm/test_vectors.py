"""Exact top-k search and hard negatives against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pressgauge.llm import ball_tree, hard_negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, score string, part int"


def floors(vector):
    return [math.floor(256 * float(np.float32(x))) for x in vector]


def usable(rows):
    """One row per id, with integer vectors; the least vector of repeated ids."""
    kept = {}
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        row = ([float(np.float32(x)) for x in vector], label)
        kept[vec_id] = min(kept.get(vec_id, row), row)
    return {i: (floors(v), label) for i, (v, label) in kept.items()}


def dot(a, b):
    return sum(x * y for x, y in zip(a, b))


def nearest(rows, step, k):
    found = usable(rows)
    out = []
    for q in (i for i in found if i % step == 0):
        best = sorted((-dot(found[q][0], v), i) for i, (v, _) in found.items() if i != q)[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    return sorted(out)


def negatives(rows, step, lowest, k):
    found = usable([r for r in rows if r[2] is not None])
    out = []
    for a in (i for i in found if i % step == 0):
        vector, label = found[a]
        scored = sorted((-dot(vector, v), i, other) for i, (v, other) in found.items() if i != a)
        for s, p in [(-s, i) for s, i, other in scored if other == label][:k]:
            hard = [(-n, i) for n, i, other in scored if other != label and lowest * s <= -100 * n <= 100 * s][:k]
            out += [(a, p, rank, i, s, n) for rank, (n, i) in enumerate(hard, 1)]
    return sorted(out)


@pytest.fixture()
def cloud():
    """Clustered vectors with copies, ties, zeros and unusable rows."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    rows = [
        (i, (centres[i % 6] + rng.normal(scale=0.2, size=8)).astype(np.float32).tolist(), i % 4, "x", i) for i in range(600)
    ]
    rows += [(600 + i, rows[10][1], i % 3, None, None) for i in range(60)]
    rows += [(660 + i, [0.0] * 8, 1, "z", 0) for i in range(5)]
    rows += [(700, None, 1, "x", 1), (701, [1.0, None] * 4, 1, "x", 1), (702, [math.nan] * 8, 1, "x", 1), (703, [math.inf] * 8, 1, "x", 1)]
    rows += [(None, rows[3][1], 1, "x", 1), (704, rows[4][1], None, "x", 1), (20, rows[20][1], 0, "again", 9), (30, [9.0] * 8, 2, "x", 1)]
    rows += [(-50, rows[7][1], 1, "x", 1), (705, [], 1, "x", 1), (706, [0.5, 0.25], 1, "x", 1)]
    return rows


@pytest.mark.parametrize("side", [16 << 20, 2048])
def test_nearest_equal_brute_force(spark, monkeypatch, cloud, side):
    monkeypatch.setattr(vectors, "SIDE_BYTES", side)
    df = spark.createDataFrame(cloud, SCHEMA)
    found = ball_tree.top_k(df, F.col("vec_id") % 10 == 0, k=5)
    assert sorted(tuple(r) for r in found.collect()) == nearest(cloud, 10, 5)


@pytest.mark.parametrize("side", [16 << 20, 2048])
def test_negatives_equal_brute_force(spark, monkeypatch, cloud, side):
    monkeypatch.setattr(vectors, "SIDE_BYTES", side)
    df = spark.createDataFrame(cloud, SCHEMA)
    found = hard_negatives.mine(df, F.col("vec_id") % 10 == 0, positives=3, negatives=3, lowest=60)
    assert sorted(tuple(r) for r in found.collect()) == negatives(cloud, 10, 60, 3)


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ball_tree.top_k(df, F.col("vec_id") % 5 == 0, k=5).collect() == []
    assert hard_negatives.mine(df, F.col("vec_id") % 5 == 0).collect() == []


def test_fewer_rows_than_asked_for(spark):
    df = spark.createDataFrame([(0, [1.0], 1, "x", 0), (1, [2.0], 1, "x", 0)], SCHEMA)
    assert [tuple(r) for r in ball_tree.top_k(df, F.col("vec_id") == 0, k=5).collect()] == [(0, 1, 1, 256 * 512)]
    assert hard_negatives.mine(df, F.col("vec_id") == 0).collect() == []


def test_large_components_stay_exact_or_fail():
    big = np.array([[float(1 << 29) + 1, 3.0]])
    a, b = vectors.exact(big, big)
    assert a.dtype == np.int64 and (a @ b.T)[0, 0] == ((1 << 29) + 1) ** 2 + 9
    with pytest.raises(OverflowError):
        vectors.exact(big * (1 << 10), big)


def test_branches_below_the_bound_are_left_out():
    rng = np.random.default_rng(3)
    centres = 5000 * rng.normal(size=(40, 4))
    points = np.floor(np.repeat(centres, 100, axis=0) + 50 * rng.normal(size=(4000, 4)))
    queries = points[::500]
    tree = ball_tree.BallTree(points)
    lengths = np.sqrt((queries ** 2).sum(axis=1))
    for node in range(len(tree.members)):
        assert (queries @ points[tree.members[node]].T <= tree.bound(queries, lengths, node)[:, None]).all()
    none = np.full(len(queries), vectors.LOWEST)
    alone = ball_tree.Search(tree, np.arange(4000), queries, np.arange(4000)[::500], 5, none)
    alone.run()
    assert alone.scored < 0.3 * len(queries) * len(points)
    known = ball_tree.Search(tree, np.arange(4000), queries, np.arange(4000)[::500], 5, alone.scores[:, 4].astype(np.int64))
    known.run()
    assert known.scored <= alone.scored


def test_reading_stops_at_the_threshold():
    rng = np.random.default_rng(4)
    rows = np.floor(256 * rng.normal(size=(4000, 2)))
    lists = hard_negatives.SortedLists(rows)
    [(row, score)] = lists.search(rows[0], np.ones(4000, bool), [(-np.inf, np.inf)], 3)
    truth = np.lexsort((np.arange(4000), -(rows @ rows[0])))[:3]
    assert row.tolist() == truth.tolist() and score.tolist() == (rows @ rows[0])[truth].tolist()
    assert lists.scored < 2000
