"""Set and vector joins against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from feedlake.llm import groups, op01_jaccard_join as by_set, op07_embedding_dedup as by_vector
from frames import frame  # noqa: F401


def closure(links, n):
    part = list(range(n))
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(part[a], part[b])
            if part[a] != low or part[b] != low:
                part[a] = part[b] = low
                changed = True
    return part


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def texts():
    r = random.Random(2)
    word = lambda: "".join(r.choices("abcdeé", k=r.randint(2, 5)))
    out = [None, "", "  ", "one", "ONE", "one two", "a b c d"]
    for size in (30, 60, 200):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for _ in range(12):
                copy = list(base)
                for _ in range(r.randint(0, size // 25)):
                    copy[r.randrange(size)] = word()
                out.append(" ".join(copy))
    passage = " ".join(word() for _ in range(40))
    out += [" ".join(word() for _ in range(60)) + " " + passage for _ in range(40)]
    return out + out[10:20]


@pytest.mark.parametrize("small", [False, True])
def test_sets(frame, monkeypatch, small):
    if small:  # buckets and groups are split
        monkeypatch.setattr(by_set, "LIMIT", 4)
        monkeypatch.setattr(groups, "LIMIT", 4)
        monkeypatch.setattr(groups, "BLOCK", 3)
    rows = texts()
    sets = [shingles(t) for t in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9]
    part = closure(links, len(rows))
    found = by_set.similar_documents(frame(rows)).collect()
    assert all(r.kept == (r.doc_id == r.class_id) for r in found)
    got = {r.doc_id: (r.class_id, r.n_links) for r in found}
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert got == {i: (part[i], degree[i]) for i in range(len(rows))}


def test_runs():
    assert by_set.runs(0.8, 0.9) < by_set.runs(0.8, 0.999) < 20


def test_set_edges(frame):
    assert by_set.similar_documents(frame([])).collect() == []
    got = sorted((r.class_id or -1, r.n_links) for r in by_set.similar_documents(frame(["a b", "a  B", None], [None, 4, 5])).collect())
    assert got == [(4, 1), (4, 1), (5, 0)]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0) for i, v in enumerate(rows)], "vec_id long, embedding array<float>, label int, node int").repartition(3)


@pytest.mark.parametrize("small", [False, True])
def test_vectors(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(by_vector, "LIMIT", 4)
        monkeypatch.setattr(groups, "LIMIT", 4)
        monkeypatch.setattr(groups, "BLOCK", 3)
    r = np.random.default_rng(1)
    base = r.normal(size=(30, 24))
    rows = [base[r.integers(30)] + 0.2 * r.normal(size=24) for _ in range(300)] + list(base[:3] * 7) + list(base[:3])
    rows = [np.asarray(v, np.float32).tolist() for v in rows]
    rows += [None, [], [0.0] * 24, [float("nan")] + [1.0] * 23, [float("inf")] + [1.0] * 23, [1.0, None], [1.0, 2.0], [2.0, 4.0]]
    good = [i for i, v in enumerate(rows) if v and None not in v and np.isfinite(v).all() and np.any(v)]
    unit = {i: np.array(rows[i], float) / np.linalg.norm(np.array(rows[i], float)) for i in good}
    links = [(i, j) for i in good for j in good if j < i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9]
    part = closure(links, len(rows))
    degree = np.bincount(np.array(links).ravel(), minlength=len(rows))
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in by_vector.near_vectors(vectors(spark, rows)).collect()}
    want = {i: (degree[i], part[i], part[i] == i) for i in range(len(rows))}
    found = sum(got[i][0] for i in want) / sum(degree)
    assert found >= 0.99 and all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i] == want[i] for i in want) >= 0.97 * len(want)


def test_vector_edges(spark):
    assert by_vector.near_vectors(vectors(spark, [])).collect() == []
    assert [tuple(x) for x in by_vector.near_vectors(vectors(spark, [None])).collect()] == [(0, 0, 0, True)]


def test_hadamard_is_a_rotation():
    x = np.random.default_rng(0).normal(size=(5, 64))
    assert np.allclose(np.linalg.norm(by_vector.rotate(x, 3), axis=1), np.linalg.norm(x, axis=1))
