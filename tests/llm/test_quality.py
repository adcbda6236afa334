"""The ordinal model: recovers order on synthetic scores, separates held-out rated texts."""

from __future__ import annotations

import numpy as np

from frames import TESTDATA, frame  # noqa: F401
from feedlake.llm import op02_quality as op


def test_thresholds_are_ordered_and_tails_fall():
    r = np.random.default_rng(0)
    x = r.integers(0, 50, 6000)
    grade = np.clip((x // 13 + r.integers(0, 2, 6000)) // 1, 0, 3)
    model = op.fit(np.arange(6000), x, np.ones(6000), grade, 4)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(model.weights[np.arange(50)])
    assert (np.diff(tails, axis=1) <= 0).all()
    assert np.corrcoef(tails.sum(1), np.arange(50))[0, 1] > 0.95


def test_held_out(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.1/documents.parquet")
    rated = op.ratings(spark.read.parquet(f"{TESTDATA}/sf0.1/labels.parquet"))
    model = op.train(docs, rated.where("doc_id % 3 <> 0"), 3)
    held = op.grade(docs.join(rated.where("doc_id % 3 = 0"), "doc_id"), model).select("grade", "_tails").toPandas()
    keep = held["_tails"].map(lambda t: t[1] >= 0.5)
    assert (keep[held.grade < 2]).mean() < 0.03
    assert (~keep[held.grade == 2]).mean() < 0.01


def test_edges(spark, frame):
    rated = spark.createDataFrame([(0, 2), (1, 0), (None, 1), (2, None)], "doc_id long, grade int")
    docs = frame([None, "", "a b", "x" * 100_000])
    model = op.train(docs, rated, 3)
    got = op.grade(docs, model)
    assert got.count() == 4 and set(docs.columns) < set(got.columns)
    assert op.grade(frame([]), op.train(frame([]), rated, 3)).collect() == []
