"""Losses against a dictionary model."""

from __future__ import annotations

import math
import random
from collections import Counter

from pytest import approx

from feedlake.llm import op10_lm_score as op
from frames import frame  # noqa: F401

TEXTS = ["a b a b c", "A, b! c", "", None, "...", "c c c c", "rare words here a b", "a b a b c"]


def model(texts, known):
    words, contexts, pairs = Counter(), Counter(), Counter()
    for t in texts:
        last = "<"
        for w in t:
            w = w if w in known else "?"
            words[w] += 1
            contexts[last] += 1
            pairs[last, w] += 1
            last = w
    return words, contexts, pairs, len(known) + 2


def loss(text, m, known):
    words, contexts, pairs, kinds = m
    total, last = 0.0, "<"
    for w in text:
        w = w if w in known else "?"
        p = op.BIGRAM_SHARE * pairs[last, w] / max(1, contexts[last]) + op.UNIGRAM_SHARE * words[w] / max(1, sum(words.values()))
        total -= math.log(p + (1 - op.BIGRAM_SHARE - op.UNIGRAM_SHARE) / kinds)
        last = w
    return total / len(text)


def test_against_dictionaries(frame):
    split = [[w for w in (t or "").lower().replace(",", " ").replace("!", " ").replace(".", " ").split()] for t in TEXTS]
    known = {"a", "b", "c"}  # the three most frequent
    target = [0, 1, 7]
    near, far = model([split[i] for i in target], known), model(split, known)
    got = {r.doc_id: r for r in op.score(frame(TEXTS), frame([TEXTS[i] for i in target]), size=5).collect()}
    for i, words in enumerate(split):
        assert got[i].n_words == len(words)
        if not words:
            assert got[i].difference is None
            continue
        assert got[i].target_loss == approx(loss(words, near, known))
        assert got[i].difference == approx(loss(words, near, known) - loss(words, far, known))


def test_edges(frame):
    assert op.score(frame([]), frame([])).collect() == []
    got = op.score(frame(["a b", "x " * 50_000], [None, 3]), frame([])).collect()
    assert all(r.target_loss > 0 for r in got)


def test_every_word_and_bigram_counts(frame, monkeypatch):
    """More words than 2**16, in more than one block and bucket: each is told apart from all others."""
    r = random.Random(7)
    names = [f"w{i}x" for i in range(70_000)]
    texts = [" ".join(names[i : i + 700]) for i in range(0, len(names), 700)]
    texts += [" ".join(r.choices(names, k=500)) for _ in range(60)] + [None, "..."] * 2
    monkeypatch.setattr(op, "BLOCK", 1 << 16, raising=False)
    monkeypatch.setattr(op, "ITEMS", 1 << 14, raising=False)
    split = [(t or "").replace(".", "").split() for t in texts]
    known, target = set(names), [*range(0, 100, 9), 120, 130, 161]
    models = []
    for m in (model([split[i] for i in target], known), model(split, known)):
        models.append((*m[:3], sum(m[0].values())))

    def mean(text, words, contexts, pairs, total):
        share = 1 - op.BIGRAM_SHARE - op.UNIGRAM_SHARE
        chances = (
            op.BIGRAM_SHARE * pairs[v, w] / max(1, contexts[v]) + op.UNIGRAM_SHARE * words[w] / total + share / (len(known) + 2)
            for v, w in zip(["<", *text], text)
        )
        return -sum(map(math.log, chances)) / len(text)

    got = op.score(frame(texts), frame([texts[i] for i in target])).collect()
    assert len(got) == len(texts)
    for x in got:
        words = split[x.doc_id]
        assert x.n_words == len(words)
        if words:
            assert (x.target_loss, x.background_loss) == approx(tuple(mean(words, *m) for m in models), rel=1e-9)
        else:
            assert x.target_loss is None and x.background_loss is None and x.difference is None


def test_target_of_other_words_and_text_ids(spark, frame):
    docs = frame(["a b", "b c"]).selectExpr("concat('d', doc_id) as doc_id", "text")
    got = {x.doc_id: x for x in op.score(docs, frame(["a b", "z z"])).collect()}
    known = {"a", "b", "c"}
    near, far = model([["a", "b"], ["z", "z"]], known), model([["a", "b"], ["b", "c"]], known)
    for i, words in (("d0", ["a", "b"]), ("d1", ["b", "c"])):
        assert got[i].target_loss == approx(loss(words, near, known)) and got[i].background_loss == approx(loss(words, far, known))


def test_texts_without_words(frame):
    got = op.score(frame([None, "", "..."]), frame(["a b"])).collect()
    assert [(x.n_words, x.target_loss, x.background_loss, x.difference) for x in got] == [(0, None, None, None)] * 3
    assert [x.n_words for x in op.score(frame([None, "a"], partitions=1), frame([None])).sort("doc_id").collect()] == [0, 1]
