"""Mined negatives against all pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedlake.llm import op13_hard_negatives as op

SCHEMA = "id long, label int, vector array<double>, row int, size string, v int"


def run(spark, rows, every=5, **kw):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(4)
    found = op.hard_negatives(df, F.col("id") % every == 0, **kw).collect()
    return sorted((tuple(r) for r in found), key=str)


def expected(rows, every=5, positives=5, negatives=3, low_share=50, high_share=95):
    sound = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [math.floor(256 * x) for x in v]
        if sum(float(x) * float(x) for x in w) < 2.0**62:
            sound.append((i, label, w))
    return sorted(op.brute_force(sound, lambda i: i % every == 0, positives, negatives, low_share, high_share), key=str)


def clusters(n, spread, seed=3, dims=12, labels=4):
    r = np.random.default_rng(seed)
    centre = r.normal(size=(labels, dims))
    return [(i, int(i % labels), (centre[i % labels] * (i % 3 > 0) + spread * r.normal(size=dims) + 0.3).tolist()) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_clusters(spark, monkeypatch, small, spread):
    if small:
        for name, value in {"ANCHORS": 7, "CANDIDATES": 40, "STEP": 9, "SPREAD": 2}.items():
            monkeypatch.setattr(op, name, value)
    rows = clusters(300, spread)
    want = expected(rows)
    assert len(want) > 100
    assert run(spark, rows) == want
    assert run(spark, rows, positives=2, negatives=1, low_share=0, high_share=100) == expected(rows, 5, 2, 1, 0, 100)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, 1 + i % 2, [1.0, 0.5]) for i in range(12)]  # ties everywhere
    rows += rows[:4] * 3 + [(5, 1, [0.9, 0.5]), (0, 2, [1.0, 0.4]), (5, 1, [0.9, 0.5])]
    rows += [(None, 1, [1.0, 0.5]), (None, 2, [0.7, 0.5]), (None, 2, [0.7, 0.5])]
    rows += [(20, None, [1.0, 1.0]), (25, 1, None), (30, 1, [1.0, None]), (35, 1, [nan, 1.0]), (40, 2, [1.0, -inf])]
    rows += [(45, 1, []), (50, 2, []), (55, 1, []), (60, 1, [1.0]), (65, 1, [0.9]), (66, 2, [0.7]), (67, 2, [1e300]), (68, 1, [3e6])]
    rows += [(70, 3, [-1.0, -1.0]), (71, 3, [0.0, 0.0]), (-5, 3, [0.0, 0.0]), (75, 4, [0.0] * 3), (76, 4, [0.0] * 3), (77, 5, [1.0] * 3)]
    for share in ({}, {"low_share": 0, "high_share": 100}):
        assert run(spark, rows, **share) == expected(rows, **share)
    assert run(spark, []) == [] and run(spark, [(0, 1, [1.0])]) == []


def test_exact_beyond_doubles(spark):
    r = np.random.default_rng(5)
    rows = [(i, i % 2, [float(x) for x in 4e5 * (1 + r.random(6))]) for i in range(60)]
    rows += [(100 + i, i % 2, [float(x) for x in 4e6 + r.random(4)]) for i in range(30)]
    assert run(spark, rows, low_share=0, high_share=100) == expected(rows, low_share=0, high_share=100)


def test_bounds_hold_and_prune():
    r = np.random.default_rng(1)
    x = np.concatenate([c + 4 * r.normal(size=(50, 16)) for c in 200 * r.normal(size=(4, 16))]).astype(np.int64)
    parent, depth, edge = op.spanning_tree(x)
    assert sorted(np.flatnonzero(parent == np.arange(len(x)))) == [int(np.flatnonzero(depth == 0)[0])]
    gaps = np.sqrt(np.square(x[:, None] - x).sum(axis=2))
    assert np.isclose(edge.sum(), _tree_weight(gaps))
    scores, c = op.Scores(x, x[::-1].copy(), parent, edge), x[::-1]
    asked = 0
    for d in range(depth.max() + 1):
        level = np.flatnonzero(depth == d)
        low, high = scores.bounds(level)
        true = x[level] @ c.T
        assert (low <= true).all() and (true <= high).all()
        wanted = high > 0.9 * true.max()
        asked += wanted.sum()
        assert (scores.settle(level, low, high, wanted)[wanted] == true[wanted]).all()
    assert asked < 0.7 * x.shape[0] ** 2


def _tree_weight(gaps):
    inside, total = {0}, 0.0
    while len(inside) < len(gaps):
        w, j = min((gaps[i, j], j) for i in inside for j in range(len(gaps)) if j not in inside)
        inside.add(j)
        total += w
    return total
