"""Removal of repeated windows against brute force: words (FM-index) and bytes (suffix array)."""

from __future__ import annotations

import random

import numpy as np
import pytest

from feedlake.llm import op04_substring_dedup as by_word, op06_suffix_dedup as by_byte, windows
from frames import frame  # noqa: F401
from feedlake.llm.suffixes import FMIndex, common_prefixes, lay_out, suffix_array

SIZE = {by_word: 6, by_byte: 20}


def texts(seed: int) -> list[str | None]:
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abé\tñ日", k=r.randint(1, 4)))
    passage = " ".join(word() for _ in range(30))
    base = [word() for _ in range(60)]
    out: list[str | None] = [None, "", " \n ", "a", "x " * 200, "y" * 300, "p q " * 5, "r s t u v w " * 2, "0123456789ab" * 3, passage, passage]
    for _ in range(25):
        copy = list(base)
        copy[r.randrange(60)] = word()
        out.append(" ".join(copy))
        out.append(" ".join(word() for _ in range(r.randint(0, 40))) + "\n" + passage + "  " + " ".join(word() for _ in range(20)))
    out.append(" ".join(word() for _ in range(3000)) + " " + passage)
    r.shuffle(out)
    return out


@pytest.mark.parametrize("op", [by_word, by_byte])
@pytest.mark.parametrize("shard", [None, 60])
def test_against_brute_force(frame, op, shard, monkeypatch):
    if shard:  # so small that anchors are dealt over several shards
        monkeypatch.setitem(windows.SHARD_UNITS, "word", shard)
        monkeypatch.setitem(windows.SHARD_UNITS, "byte", shard)
    rows = texts(3)
    got = {r.doc_id: r for r in op.remove_repeats(frame(rows), SIZE[op]).collect()}
    assert len(got) == len(rows)
    left = op.brute_force(rows, SIZE[op])
    for i, kept in enumerate(left):
        if op is by_word:
            assert got[i].kept == " ".join(kept)
            assert got[i].n_words - got[i].n_removed == len(kept)
        else:
            assert bytes(got[i].kept) == kept
            assert got[i].n_bytes - got[i].n_removed == len(kept)


@pytest.mark.parametrize("op", [by_word, by_byte])
def test_edges(frame, op):
    assert op.remove_repeats(frame([]), 5).collect() == []
    same = "one two three four five six seven"
    rows = op.remove_repeats(frame([same, same, None], [1, 1, None]), 5).collect()
    assert sorted(r.n_removed for r in rows) == ([0, 7, 7] if op is by_word else [0, len(same), len(same)])


def test_suffix_order_and_prefixes():
    r = random.Random(5)
    strings = [np.array([r.randint(1, 3) for _ in range(r.randint(1, 60))]) for _ in range(20)]
    text, at = lay_out(strings)
    sa = suffix_array(text, at, 10_000)
    end = np.repeat(at[1:] - 1, np.diff(at))
    suffix = [tuple(text[i : end[i]]) for i in range(len(text))]
    assert [suffix[i] for i in sa] == sorted(suffix)
    shared = common_prefixes(text, at, sa, 10_000)
    for a, b in zip(sa, sa[1:], strict=False):
        want = next((k for k, (x, y) in enumerate(zip(suffix[a], suffix[b], strict=False)) if x != y), min(len(suffix[a]), len(suffix[b])))
        assert shared[b] == want


def test_matching_statistics():
    r = random.Random(8)
    strings = [np.array([r.randint(1, 4) for _ in range(r.randint(3, 40))]) for _ in range(12)]
    text, at = lay_out(strings)
    index = FMIndex(text, at, 7)
    ends = np.concatenate([np.arange(a + 1, b) for a, b in zip(at, at[1:], strict=False)])
    got = index.matching_statistics(text, ends, 7)
    whole = "".join(map(chr, text))
    for end, n in zip(ends, got, strict=True):
        want = 0
        for k in range(1, 8):
            if end - k < 0 or 0 in text[end - k : end]:
                break
            piece = "".join(map(chr, text[end - k : end]))
            if sum(whole.startswith(piece, i) for i in range(len(whole))) < 2:
                break
            want = k
        assert n == want


@pytest.mark.parametrize("op", [by_word, by_byte])
def test_judge_over_long_shared_runs(op):
    """Strings longer than what the first sort and the doubling steps reach, with runs in common."""
    size = 10
    for seed in range(150):
        r = np.random.default_rng(seed)
        letters = int(r.integers(2, 6))
        base = r.integers(1, letters + 1, 150)
        strings = []
        for _ in range(int(r.integers(2, 7))):
            a = int(r.integers(0, 100))
            own = np.concatenate([r.integers(1, letters + 1, int(r.integers(0, 30))), base[a : a + int(r.integers(5, 50))]])
            if r.random() < 0.3:
                own = np.concatenate([own, own])
            strings.append(np.concatenate([own, r.integers(1, letters + 1, size)]))
        starts = {}
        for s in strings:
            for i in range(len(s) - size + 1):
                starts[s[i : i + size].tobytes()] = starts.get(s[i : i + size].tobytes(), 0) + 1
        for s, repeated in zip(strings, op.judge(strings, np.ones(len(strings), bool), size), strict=True):
            assert repeated.tolist() == [starts[s[i : i + size].tobytes()] > 1 for i in range(len(s) - size + 1)]
