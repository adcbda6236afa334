"""Phrase and proximity matches against a scan of all texts."""

from __future__ import annotations

import random
import re

import pytest

from feedlake.llm import op03_decontaminate as op
from frames import frame  # noqa: F401

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def make(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abÉ9", k=r.randint(1, 2)))
    items = [" ".join(word() for _ in range(r.randint(1, 20))) for _ in range(12)] + [None, "", "?!", "Solo"]
    items.append(items[0])
    docs = [None, "", "solo", "Solo,SOLO"]
    for _ in range(40):
        docs.append(", ".join(word() for _ in range(r.randint(0, 30))) + "\n" + r.choice([i or "" for i in items]).upper().replace("É", "É") + " " + word())
    docs += [docs[5]] * 2
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_phrases(spark, frame, seed):
    docs, items = make(seed)
    table = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)], "item_id long, text string, pos int")
    got = {r.doc_id: r for r in op.contamination(frame(docs), table, 4).collect()}
    assert len(got) == len(docs)
    for i, text in enumerate(docs):
        own, hit, names = split(text), set(), set()
        for j, item in enumerate(items):
            w = split(item)
            n = min(4, len(w))
            for k in range(len(w) - n + 1 if w else 0):
                for s in range(len(own) - n + 1):
                    if own[s : s + n] == w[k : k + n]:
                        hit.update(range(s, s + n))
                        names.add(str(j))
        assert (got[i].n_words, got[i].n_hit, got[i]["items"]) == (len(own), len(hit), sorted(names))


def test_several_blocks_agree(spark, frame, monkeypatch):
    docs, items = make(4)
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    columns = ["doc_id", "n_words", "n_hit", "items"]
    whole = sorted(op.contamination(frame(docs), table, 4).select(columns).collect())
    monkeypatch.setattr(op, "BLOCK_TERMS", 40)
    assert sorted(op.contamination(frame(docs), table, 4).select(columns).collect()) == whole


def test_proximity(spark, frame):
    docs = ["x alpha y beta z gamma", "gamma alpha " + "q " * 30 + "beta", "beta gamma alpha", None]
    items = spark.createDataFrame([(0, "alpha beta gamma the"), (1, "missing alpha")], "item_id long, text string")
    got = sorted((r.item_id, r.doc_id, r.start, r.stop) for r in op.proximity_matches(frame(docs), items, terms=4, span=6).collect())
    assert got == []
    items = spark.createDataFrame([(0, "alpha beta gamma"), (1, "alpha zeta")], "item_id long, text string")
    got = sorted((r.item_id, r.doc_id, r.start, r.stop) for r in op.proximity_matches(frame(docs), items, terms=3, span=6).collect())
    assert got == [("0", 0, 1, 5), ("0", 2, 0, 2)]


def test_empty(spark, frame):
    items = spark.createDataFrame([(0, None)], "item_id long, text string")
    assert op.contamination(frame([]), items).collect() == []
    assert [r.n_hit for r in op.contamination(frame(["a", None]), items).collect()] == [0, 0]
    assert [r.n_hit for r in op.contamination(frame(["a", None]), items.limit(0)).collect()] == [0, 0]
