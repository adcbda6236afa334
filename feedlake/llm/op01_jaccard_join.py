"""N-gram Jaccard join: chosen paths over sampled shared tokens, repeated for recall.

A text is the set of its runs of five words (lower case; an item of fewer words is one run).
Texts with equal sets form a class, found by an aggregate; all that follows handles one node per
class. A class is embedded as 64 MinHash tokens, equal in each place with the sets' Jaccard
similarity. In a run, a bucket of classes is split by sampled tokens: every class enters the
children named by those of its tokens whose hash, seeded by the bucket's path, is below
1 / (threshold * 64); so classes at the threshold are expected to share one child, similar ones
more. Buckets of at most ``LIMIT`` classes are brute-forced on their tokens; larger ones are
split again, unless two of its classes agree in a token with even odds, or ``DEPTH`` levels are
behind it: it is then dense, as splitting would show again and again, and kept whole. ``runs`` gives the
number of independent runs for a target recall. Candidates are then verified exactly on their
sets (see ``groups``), so no link is reported below the threshold.

Defined results: a null or empty text, or one without words, links with nothing. Copies with
equal sets link with each other and share all links. Ids may be null or repeated; further
columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import components, stage
from feedlake.llm.groups import LIMIT, batched, bucket_edges, coarse_groups, exact_links, sized_buckets
from feedlake.llm.words import chunks, gram_hashes, mix, words

TOKENS, DEPTH = 64, 5
#: MinHash estimates this many standard errors below the threshold are still verified.
SLACK = 3.5

_random = np.random.default_rng(20240607)
_FACTORS = _random.integers(0, 1 << 32, TOKENS, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_SHIFTS = _random.integers(0, 1 << 32, TOKENS, dtype=np.uint64).astype(np.uint32)


def runs(threshold: float, recall: float) -> int:
    """Independent runs for the recall of a pair at the threshold, found in one run if it shares
    a path of two levels: the number of shared children is Poisson with mean 1 at each."""
    once = 1 - math.exp(-(1 - math.exp(-1)))
    return math.ceil(math.log(1 - recall) / math.log(1 - once))


def _sets(column: pa.Array, k: int):
    """(first row, row starts, sorted different hashes) of the texts of each chunk."""
    for chunk in chunks(column):
        grams, at = gram_hashes(words(chunk), k)
        text = np.repeat(np.arange(len(at) - 1), np.diff(at))
        order = np.lexsort((grams, text))
        grams, text = grams[order], text[order]
        keep = np.ones(len(grams), bool)
        keep[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
        grams, text = grams[keep], text[keep]
        yield chunk, np.searchsorted(text, np.arange(len(at))), grams


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return (total[at[1:]] - total[at[:-1]]).view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, d, h, node, check, n, tokens binary) of each row: node and check are sums of
    hashes over the set, n its size. Staged."""

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for chunk, at, grams in _sets(batch.column(3), k):
            size = np.diff(at)
            some = np.flatnonzero(size)
            tokens = np.zeros((len(size), TOKENS), np.uint32)
            if len(some):
                short = (mix(grams) >> np.uint64(32)).astype(np.uint32)
                for i in range(TOKENS):
                    x = (short ^ _SHIFTS[i]) * _FACTORS[i]
                    x ^= x >> np.uint32(15)
                    tokens[some, i] = np.minimum.reduceat(x * np.uint32(0x2C1B3C6D), at[:-1][some])
            rows = tokens.view(np.uint8).reshape(len(size), -1)
            ends = np.arange(len(size) + 1, dtype=np.int32) * (4 * TOKENS)
            packed = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(rows.tobytes())])
            out.append((_sums(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), at), _sums(mix(grams), at), size, packed))
        node, check, n, tokens = (([x[i] for x in out]) for i in range(4))
        flat = lambda parts: pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:3], flat(node), flat(check), flat(n), pa.concat_arrays(tokens) if tokens else pa.array([], pa.binary())],
            ["doc_id", "d", "h", "node", "check", "n", "tokens"],
        )

    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.hash("doc_id", "text").alias("h"), "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stage(rows.mapInArrow(batched(make), f"doc_id {kind}, d long, h int, node long, check long, n long, tokens binary"))


def _split(rows: DataFrame, threshold: float) -> DataFrame:
    """(path, node) of the children of (path, node, tokens)."""
    odds = np.uint64(int((1 << 64) / (threshold * TOKENS)) & ((1 << 64) - 1))

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not len(batch):
            return pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64())], ["path", "node"])
        held = batch.column(2)
        tokens = np.frombuffer(held.buffers()[2], np.uint32)[held.offset * TOKENS :][: len(held) * TOKENS].reshape(-1, TOKENS)
        path = np.asarray(batch.column(0)).view(np.uint64)
        token = tokens.astype(np.uint64) | (np.arange(TOKENS, dtype=np.uint64) << np.uint64(32))
        child = mix(mix(path)[:, None] ^ mix(token))
        row, place = np.nonzero(mix(child) < odds)
        return pa.RecordBatch.from_arrays([pa.array(child[row, place].view(np.int64)), batch.column(1).take(pa.array(row))], ["path", "node"])

    return rows.select("path", "node", "tokens").mapInArrow(batched(make), "path long, node long")


def _dense(rows: DataFrame) -> DataFrame:
    """Paths of (path, node, tokens) of which two nodes agree with odds of a half or more, at each
    of three places; the places are the path's own, as it has an agreed one for each level."""
    agreed = None
    for place in range(3):
        at = F.pmod(F.xxhash64("path", F.lit(place)), F.lit(TOKENS)).cast("int")
        token = F.expr("substring(tokens, 4 * at + 1, 4)")
        counts = rows.withColumn("at", at).groupBy("path", token.alias("token")).agg(F.count(F.lit(1)).alias("n"))
        odds = counts.groupBy("path").agg((F.sum(F.col("n") * F.col("n")) / (F.sum("n") * F.sum("n"))).alias("odds"))
        own = odds.where("odds >= 0.5").select("path")
        agreed = own if agreed is None else agreed.join(own, "path")
    return agreed


def candidate_groups(classes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(node, group) of (node, tokens): groups that hold each pair the runs find."""
    least = threshold - SLACK * math.sqrt(threshold * (1 - threshold) / TOKENS)

    def alike(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x.view(np.uint32) == y.view(np.uint32)).mean(axis=1) >= least

    start = classes.select(F.explode(F.sequence(F.lit(1).cast("long"), F.lit(runs(threshold, recall)).cast("long"))).alias("path"), "node", "tokens")
    found, large, whole = None, start, []
    for level in range(DEPTH):
        buckets = stage(sized_buckets(_split(large, threshold)))
        # Staged, as the driver would otherwise hold the plans and tasks of all levels in one job.
        edges = stage(bucket_edges(buckets, classes.select("node", "tokens"), "tokens", alike))
        found = edges if found is None else found.union(edges)
        big = buckets.where(f"size > {LIMIT}").select("path", "node")
        if level + 1 == DEPTH or big.isEmpty():
            whole.append(big)
            break
        big = stage(big.join(classes.select("node", "tokens"), "node"))
        close = stage(_dense(big))
        whole.append(big.join(close, "path").select("path", "node"))
        large = stage(big.join(close, "path", "left_anti"))
    return coarse_groups(found, reduce(DataFrame.union, whole))


def _set_payload(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(node, c, grams array<long>) of the texts at (d, h). The wanted texts' keys, as numbers
    modulo 2**20 and so at most as many, are broadcast to leave most other texts unshuffled."""
    pick = F.pmod(F.xxhash64("d", "h"), F.lit(1 << 20))
    picks = wanted.select(pick.alias("pick")).distinct()
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.hash("doc_id", "text").alias("h"), "text")
    some = rows.withColumn("pick", pick).join(F.broadcast(picks), "pick", "left_semi")
    texts = some.join(wanted, ["d", "h"]).select("node", "c", "text")

    def make(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, grams = [np.zeros(1, np.int64)], [np.zeros(0, np.uint64)]
        for _, own, found in _sets(batch.column(2), k):
            at.append(own[1:] + at[-1][-1])
            grams.append(found)
        lists = pa.ListArray.from_arrays(np.concatenate(at).astype(np.int32), np.concatenate(grams).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], ["node", "c", "grams"])

    sets = texts.mapInArrow(batched(make), "node long, c long, grams array<long>")
    return sets.dropDuplicates(["node"])


def overlaps(threshold: float):
    """Compares sets exactly: each set of the first block marks its members, and the marks under
    every other set are counted."""

    def compare(table: pa.Table, first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        if second is None and len(first) < 2:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rows = first if second is None else np.concatenate([first, second])
        lists = table["grams"].combine_chunks().take(pa.array(rows))
        size = np.asarray(pa.compute.list_value_length(lists), np.int64)
        _, flat = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        at = np.concatenate([[0], np.cumsum(size)])
        marked, left, right = np.zeros(int(flat.max(initial=0)) + 1, np.int32), [], []
        for i in range(len(first)):
            from_row = i + 1 if second is None else len(first)
            if from_row == len(rows):
                break
            own = flat[at[i] : at[i + 1]]
            marked[own] = 1
            shared = np.add.reduceat(marked[flat[at[from_row] :]], at[from_row:-1] - at[from_row])
            marked[own] = 0
            hit = np.flatnonzero(shared >= threshold * (size[i] + size[from_row:] - shared) - 1e-9)
            left.append(np.full(len(hit), rows[i])), right.append(rows[from_row + hit])
        return np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right])

    return compare


def similar_documents(docs: DataFrame, threshold: float = 0.8, k: int = 5, recall: float = 0.999) -> DataFrame:
    """Per row of ``docs``: (doc_id, d, h, class_id, n_links, kept): the smallest id of its
    connected group, how many other rows it is linked with directly, and whether it is the one
    of its group that stays. (d, h) stand for id and text: rows equal in both are kept alike."""
    rows = signatures(docs, k)
    some = rows.where("n > 0")
    classes = stage(
        some.groupBy("node", "check", "n").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("d", "h")).alias("ref"), F.min("doc_id").alias("least_id"), F.min("tokens").alias("tokens"))
    )
    groups = stage(candidate_groups(classes, threshold, recall))
    wanted = stage(groups.join(classes, "node").select("node", "c", "ref.d", "ref.h"))
    counts, edges = exact_links(groups, _set_payload(docs, wanted, k), overlaps(threshold))
    linked = components(edges)
    placed = classes.join(counts, "node", "left").join(linked, "node", "left").select("node", "check", "c", "links", "least_id", "ref", F.coalesce("component", "node").alias("part"))
    ids = placed.groupBy("part").agg(F.min("least_id").alias("class_id"), F.min("ref").alias("stays"))
    named = placed.join(ids, "part").select("node", "check", "class_id", "stays", (F.coalesce("links", F.lit(0)) + F.col("c") - 1).alias("links"))
    out = rows.select("doc_id", "d", "h", "node", "check", "n").join(named, ["node", "check"], "left")
    alone = F.col("n") == 0
    return out.select(
        "doc_id",
        "d",
        "h",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("links")).cast("long").alias("n_links"),
        (alone | (F.struct("d", "h") == F.col("stays"))).alias("kept"),
    )
