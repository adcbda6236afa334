"""Ids equal to the public library's, and exact round trips."""

from __future__ import annotations

import base64

import pytest
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings, strategies as st

from feedlake.llm import op08_bpe as op
from frames import TESTDATA, frame  # noqa: F401

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [
    None, "", " ", "  ", "a  b", " \n x", "x \n\n  y", "it's  'll ok", " lead", "trail ", "a\n b", "a \nb", "tab\t x", "\x00a \x00b", "a b  c",
    "　y z", "日本語 テキスト é́", "a" * 3000, " '", " a 's b", "'sword", "1 2  3\r\n 4", "😀 👩‍👩‍👧", "a  b",
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_edges(frame, library):
    got = {r.doc_id: r for r in op.encode(frame(TEXTS), RANKS, P.PATTERN, decoded=True).collect()}
    for i, text in enumerate(TEXTS):
        assert list(got[i].ids) == library.encode_ordinary(text or "")
        assert bytes(got[i].decoded).decode() == (text or "")
    assert op.encode(frame([]), RANKS, P.PATTERN).collect() == []


def test_documents(spark, library):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    encoded = op.encode(docs, RANKS, P.PATTERN)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op.decode(encoded, RANKS, P.PATTERN).collect():
        assert list(r.ids) == library.encode_ordinary(texts[r.doc_id])
        assert bytes(r.decoded).decode() == texts[r.doc_id]


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("ab ' \n\tsé1!日 ")), max_size=30), max_size=5))
def test_any_text(library, texts):
    c = op.codec(RANKS, P.PATTERN)
    ids, lengths = c.encode(texts)
    at = 0
    for text, n in zip(texts, lengths, strict=True):
        assert ids[at : at + n].tolist() == library.encode_ordinary(text)
        at += n
    assert [x.decode() for x in c.decode(ids, lengths)] == texts


def test_small_caches(library, monkeypatch):
    monkeypatch.setattr(op, "CACHE_ENTRIES", 3)
    c = op.Codec(RANKS, P.PATTERN)
    for text in ("one two three four five", "six two one", "one"):
        ids, lengths = c.encode([text])
        assert ids.tolist() == library.encode_ordinary(text) and c.decode(ids, lengths) == [text.encode()]


def test_unknown_ids_raise(spark):
    bad = spark.createDataFrame([(1, [60_000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="not in the vocabulary"):
        op.decode(bad, RANKS, P.PATTERN).collect()
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [bytes(r.decoded) for r in op.decode(none, RANKS, P.PATTERN).collect()] == [b"", b""]


@pytest.mark.parametrize("word", ["a" * 50_000, "abcdefgh" * 60], ids=["one", "eight"])
def test_long_words(library, word):
    import resource

    c = op.Codec(RANKS, P.PATTERN)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    ids, lengths = c.encode([word])
    assert ids.tolist() == library.encode_ordinary(word) and c.decode(ids, lengths) == [word.encode()]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 1_500_000


def test_rounds_go_on_in_the_next_query(library, monkeypatch):
    monkeypatch.setattr(op, "ROUND_ROWS", 1_000)
    monkeypatch.setattr(op, "LONG_BYTES", 8)
    monkeypatch.setattr(op, "PIECES_BYTES", 20)
    c = op.Codec(RANKS, P.PATTERN)
    for text in ("abracadabraxyzzyquux" * 8, "antidisestablishmentarianism and internationalisation", "aaaaaaaaaaaaaaab"):
        ids, _ = c.encode([text])
        assert ids.tolist() == library.encode_ordinary(text)


def test_frequent_words_stay_when_the_store_is_full(library, monkeypatch):
    monkeypatch.setattr(op, "CACHE_ENTRIES", 30)
    c = op.Codec(RANKS, P.PATTERN)
    for i in range(40):
        texts = ["often again", f"rareword{i}xq unheard{i}of, {i}\n  y", None, "", f" a\n{i}"]
        ids, lengths = c.encode(texts)
        assert ids.tolist() == [x for text in texts for x in library.encode_ordinary(text or "")]
        assert c.decode(ids, lengths) == [(text or "").encode() for text in texts]
        assert len(c.stretches.code) <= 30 and "again" in c.stretches.code


def test_a_round_sorts_nothing():
    """Windows over all rows of a round took most of the time of the recursive query."""
    assert " over " not in op._ENCODE
