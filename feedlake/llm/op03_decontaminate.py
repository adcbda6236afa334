"""Benchmark decontamination by a distributed positional inverted index.

The postings (term, text, position) of training tokens are stored for the terms that the test
items have. A match is a run of test terms, so only tokens in runs at least as long as the
shortest window are posted: no match is lost, and common words alone post little. Each window
is looked up by its rarest term, which gives candidate starts; the offset-adjusted postings of
its next rarest term, and then of all its terms, must meet there. All of it is joins on
(term) or (text, position, term), which adaptive execution splits where a term or text is hot.

Terms are held in the index as 64-bit hashes. Test items are taken in blocks of at most
``BLOCK_TERMS`` words, the bound of what a pass over the texts is sent.

Defined results: null and empty texts have no words; an item without words matches nothing; an
item of fewer than ``size`` words is one window; ids may be null or repeated (rows equal in id
and text share one result); further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import stage
from feedlake.llm.words import chunks, words

#: Words of test items whose hashes are broadcast at once (8 bytes each).
BLOCK_TERMS = 1_000_000

_KEY = ["d", "h"]


def test_terms(items: DataFrame) -> DataFrame:
    """(item_id string, terms array<long>) of items that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                w = words(chunk)
                terms = pa.ListArray.from_arrays(w.at.astype(np.int32), w.hash.view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.last - chunk.first), terms], ["item_id", "terms"])

    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return rows.mapInArrow(run, "item_id string, terms array<long>").where(F.size("terms") > 0)


def windows(terms: DataFrame, size: int) -> DataFrame:
    """(item_id, window, terms): the runs of ``size`` terms, or all terms of a shorter item."""
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("terms") - F.lit(size - 1)))
    cut = terms.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("terms", i, F.lit(size)))).alias("terms"))
    return cut.select("item_id", F.xxhash64("terms").alias("window"), "terms").distinct()


def index(docs: DataFrame, terms: np.ndarray, least: int) -> DataFrame:
    """One row per row of ``docs``: (doc_id, d, h, n_words, postings). Staged."""
    held = docs.sparkSession.sparkContext.broadcast(np.unique(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = held.value
        for batch in batches:
            for chunk in chunks(batch.column(3)):
                w = words(chunk)
                value = w.hash.view(np.int64)
                place = np.minimum(np.searchsorted(known, value), max(len(known) - 1, 0))
                inside = known[place] == value if len(known) else np.zeros(len(value), bool)
                text = w.text_of()
                begins = inside.copy()
                begins[1:] &= ~inside[:-1] | (text[1:] != text[:-1])
                run_of = np.cumsum(begins)
                long_enough = np.bincount(run_of[inside], minlength=len(value) + 1) >= least
                posted = np.flatnonzero(inside & long_enough[run_of])
                at = np.searchsorted(text[posted], np.arange(len(chunk.at))).astype(np.int32)
                postings = pa.StructArray.from_arrays([pa.array(value[posted]), pa.array((posted - w.at[text[posted]]).astype(np.int32))], ["term", "pos"])
                rows = [c.slice(chunk.first, chunk.last - chunk.first) for c in batch.columns[:3]]
                yield pa.RecordBatch.from_arrays([*rows, pa.array(np.diff(w.at)), pa.ListArray.from_arrays(at, postings)], ["doc_id", "d", "h", "n_words", "postings"])

    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.hash("doc_id", "text").alias("h"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(rows.mapInArrow(run, f"doc_id {kind}, d long, h int, n_words long, postings array<struct<term:long,pos:int>>"))


def _postings(indexed: DataFrame) -> DataFrame:
    return indexed.select("d", "h", F.explode("postings").alias("p")).select("d", "h", "p.term", "p.pos")


def phrase_matches(indexed: DataFrame, wanted: DataFrame) -> DataFrame:
    """(window, d, h, start, n): where all terms of a window stand in order."""
    postings = _postings(indexed)
    each = wanted.select("window", "terms").distinct().select("window", F.size("terms").alias("n"), F.posexplode("terms").alias("offset", "term"))
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    # A term without postings rules its window out.
    ranked = each.join(counts, "term").groupBy("window", "n").agg(F.array_sort(F.collect_list(F.struct("texts", "offset", "term"))).alias("by_count"))
    ranked = stage(ranked.where("size(by_count) = n"))
    rarest = ranked.select("window", "n", F.col("by_count")[0].alias("first"), F.when(F.col("n") > 1, F.col("by_count")[1]).alias("second"))
    starts = (
        rarest.select("window", "n", "second", F.col("first.term").alias("term"), F.col("first.offset").alias("offset"))
        .join(postings, "term")
        .select("window", "n", "second", "d", "h", (F.col("pos") - F.col("offset")).alias("start"))
        .where("start >= 0")
    )
    one = starts.where("n = 1").select("window", "n", "d", "h", "start")
    two = (
        starts.where("n > 1")
        .select("window", "n", "d", "h", "start", F.col("second.term").alias("term"), (F.col("start") + F.col("second.offset")).alias("pos"))
        .join(postings, [*_KEY, "pos", "term"])
        .select("window", "n", "d", "h", "start")
    )
    candidates = stage(one.union(two).distinct())
    asked = candidates.join(ranked.select("window", "by_count"), "window").select("window", "n", "d", "h", "start", F.explode("by_count").alias("t"))
    met = asked.select("window", "n", "d", "h", "start", F.col("t.offset").alias("offset"), F.col("t.term").alias("term"), (F.col("start") + F.col("t.offset")).alias("pos")).join(
        postings.distinct(), [*_KEY, "pos", "term"]
    )
    return met.groupBy("window", "n", "d", "h", "start").agg(F.count(F.lit(1)).alias("met")).where("met = n").drop("met")


def _blocks(items: DataFrame) -> Iterator[DataFrame]:
    """The terms of the items, in parts of about ``BLOCK_TERMS`` terms."""
    listed = stage(test_terms(items))
    total = listed.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // BLOCK_TERMS) or 1
    for block in range(blocks):
        yield listed.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block)


def _known(part: DataFrame) -> np.ndarray:
    return np.asarray(part.select(F.explode("terms").alias("term")).distinct().toArrow()["term"].combine_chunks(), np.int64)


def proximity_matches(docs: DataFrame, items: DataFrame, terms: int = 3, span: int = 20) -> DataFrame:
    """(item_id, doc_id, start, stop): where the ``terms`` rarest different terms of an item, or
    all it has, stand within ``span`` words, in any order; start and stop are the outermost.
    A place is reported by its leftmost term."""
    return reduce(DataFrame.union, (_proximity(docs, part, terms, span) for part in _blocks(items)))


def _proximity(docs: DataFrame, listed: DataFrame, terms: int, span: int) -> DataFrame:
    found = index(docs, _known(listed), 1)
    postings = _postings(found)
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("texts"))
    each = listed.select("item_id", F.explode(F.array_distinct("terms")).alias("term"))
    rare = each.join(counts, "term", "left").groupBy("item_id").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "term"))), 1, terms).alias("rare"))
    asked = rare.select("item_id", F.size("rare").alias("n"), F.explode("rare").alias("r")).select("item_id", "n", F.col("r.term").alias("term"))
    placed = asked.join(postings.distinct(), "term").select("item_id", "n", "d", "h", "term", "pos")
    # Each place meets the places of its own and the next stretch of ``span`` words.
    left = placed.select("item_id", "n", "d", "h", F.col("pos").alias("start"), F.explode(F.array(F.floor(F.col("pos") / span), F.floor(F.col("pos") / span) + 1)).alias("stretch"))
    right = placed.select("item_id", "d", "h", "term", "pos", F.floor(F.col("pos") / span).alias("stretch"))
    near = left.join(right, ["item_id", *_KEY, "stretch"]).where(f"pos >= start and pos < start + {span}")
    nearest = near.groupBy("item_id", "n", "d", "h", "start", "term").agg(F.min("pos").alias("pos"))
    full = nearest.groupBy("item_id", "n", "d", "h", "start").agg(F.count(F.lit(1)).alias("terms"), F.max("pos").alias("stop")).where("terms = n")
    return full.join(found.select("doc_id", "d", "h").distinct(), _KEY).select("item_id", "doc_id", "start", "stop")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """Per row of ``docs``: (doc_id, d, h, n_words, n_hit, items array<string> sorted)."""
    hits, rows = None, None
    for part in _blocks(items):
        wanted = stage(windows(part, size))
        known = _known(part)
        least = wanted.agg(F.min(F.size("terms"))).first()[0] or 1
        indexed = index(docs, known, least)
        rows = rows if rows is not None else indexed.select("doc_id", "d", "h", "n_words")
        found = phrase_matches(indexed, wanted).join(wanted.select("window", "item_id"), "window").select("d", "h", "start", "n", "item_id")
        hits = found if hits is None else hits.union(found)
    hits = stage(hits)
    spots = hits.select("d", "h", F.explode(F.expr("sequence(start, start + n - 1)")).alias("pos")).distinct().groupBy(_KEY).agg(F.count(F.lit(1)).alias("n_hit"))
    names = hits.select("d", "h", "item_id").distinct().groupBy(_KEY).agg(F.array_sort(F.collect_list("item_id")).alias("items"))
    return rows.join(spots, _KEY, "left").join(names, _KEY, "left").select(
        "doc_id", "d", "h", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items")
    )
