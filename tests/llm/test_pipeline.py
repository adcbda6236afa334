"""The stages in a row, each held against plain Python over its own input."""

from __future__ import annotations

import base64
import re

import public_tokenizers
import tiktoken

import corpus_pipeline
from pyspark.sql import functions as F
from feedlake.llm import op02_quality
from feedlake.llm.common import stage
from frames import TESTDATA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = f"{TESTDATA}/sf0.01"


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def near(docs):
    sets = {}
    for i, text in docs.items():
        w = split(text)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    part = {i: i for i in docs}
    ids = sorted(docs)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9]
    while True:
        old = dict(part)
        for a, b in links:
            part[a] = part[b] = min(part[a], part[b])
        if part == old:
            return {i for i in ids if part[i] == i}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    benchmark = [split(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    phrases = {tuple(w[k : k + 10]) for w in benchmark for k in range(max(1, len(w) - 9)) if w}
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    coding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, step in corpus_pipeline.STAGES:
        out = stage(step(spark, docs, SF))
        rows = {r.doc_id: r for r in out.collect()}
        assert len(rows) == out.count()
        if name == "quality":
            bad = [i for i, x in labels.items() if x.toxic or not x.quality]
            good = [i for i, x in labels.items() if x.quality and not x.toxic]
            assert sum(i in rows for i in bad) <= 0.2 * len(bad) and sum(i in rows for i in good) >= 0.95 * len(good)
        elif name == "line_dedup":
            assert set(rows) == set(before)
            for i, r in rows.items():
                kept, own = r.text.split("\n"), before[i].split("\n")
                assert r.n_chars == len(r.text)
                at = iter(own)
                assert r.text == "" or all(line in at for line in kept)
            exact = [line for r in rows.values() for line in r.text.split("\n") if line.strip()]
            assert len(exact) == len(set(exact))
        elif name == "near_duplicates":
            assert set(rows) == near(before)
        elif name == "decontaminate":
            leak = {i for i, t in before.items() if phrases & {tuple(split(t)[k : k + n]) for n in {len(p) for p in phrases} for k in range(len(split(t)) - n + 1)}}
            assert set(rows) == set(before) - leak
        else:
            assert {i: list(r.ids) for i, r in rows.items()} == {i: coding.encode_ordinary(t) for i, t in before.items()}
            break
        assert out.columns == docs.columns
        docs, before = out, {i: r.text for i, r in rows.items()}
    assert op02_quality.BITS == 20


def test_near_duplicates_on_whole_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect()}
    assert kept == near({r.doc_id: r.text for r in docs.collect()})


def test_edges(spark):
    kind = spark.read.parquet(f"{SF}/documents.parquet").schema
    empty = spark.createDataFrame([], kind)
    odd = spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "a", 0), (1, "a b", None, "s", 3), (1, "a b", "en", "s", 3)], kind)
    for _, step in corpus_pipeline.STAGES:
        assert step(spark, empty, SF).collect() == []
    for _, step in corpus_pipeline.STAGES[1:]:
        assert step(spark, odd, SF).count() <= 4
    assert corpus_pipeline.near_duplicates(spark, odd, SF).where("doc_id = 1").count() == 1


def test_columns_that_clash(spark):
    names = ("d", "h", "_d", "_h", "_n", "_tails", "_gone", "grade", "pick")
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    wide = docs.select("*", *(F.lit(c).alias(c) for c in names))
    for _, step in corpus_pipeline.STAGES[:4]:
        plain = step(spark, docs, f"{TESTDATA}/sf0.001").select("doc_id", "text")
        out = step(spark, wide, f"{TESTDATA}/sf0.001")
        assert out.columns == wide.columns
        assert sorted(map(tuple, out.select("doc_id", "text").collect())) == sorted(map(tuple, plain.collect()))
        assert out.select(*names).distinct().count() == 1
