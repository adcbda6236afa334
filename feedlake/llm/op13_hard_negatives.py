"""Hard negatives by bounds along a spanning tree of the anchors.

Anchors are dealt into blocks, and each block gets a minimum spanning tree over the distances of
its anchors, computed once. A task meets one block of anchors with one block of candidates: it
scores the tree's root against every candidate and then goes down level by level. A child's score
of a candidate lies within its parent's, plus or minus the length of the edge times the norm of
the candidate; only candidates whose interval overlaps what the anchor looks for are scored again,
the others pass their interval on, widened. Two rounds use this: the first looks for scores above
an anchor's best positives so far, the second for scores inside the windows that the positives
open, above the negatives a window already has. What a task finds is a few rows per anchor; their
merging keeps the first few of a key in every map task.

Scores are whole numbers and exact, in doubles where all partial sums stay below 2**53, else in
64-bit integers. The blocks bound the memory of a task; the work is anchors times rows, spread over
pairs of blocks, and no pair of rows is ever emitted.

Defined results: rows with a null label, a null vector or a null or non-finite component take no
part, nor do vectors whose integer squares sum to 2**62 or more, as their products exceed a long.
Vectors of different lengths are never compared. Repeated rows (equal id, label and vector) are one
row; rows that share an id only are different rows. A row without an id is no anchor and comes last
among ties. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlake.llm.common import narrow, stage

#: Anchors and candidates of a task, tasks a small table is spread over, candidates at a time.
ANCHORS, CANDIDATES, SPREAD, STEP = 4_096, 16_384, 24, 1_024
#: Stands for a missing id, after all others.
NO_ID = (1 << 63) - 1
_LEAST = -(1 << 62) - 1

_ROW = "row long, id long, label long, vector binary"


def integers(table: DataFrame, scale: int = 256) -> DataFrame:
    """(id, label, v array<long>): the rows that take part, components as whole numbers."""
    held = narrow(table, "id", "label", "vector").withColumn("v", F.col("vector").cast("array<double>"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    held = held.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    whole = F.transform("v", lambda x: F.floor(x * scale).cast("double"))
    held = held.select("id", F.col("label").cast("long").alias("label"), whole.alias("w"))
    norm = F.aggregate("w", F.lit(0.0), lambda s, x: s + x * x)
    return held.where(norm < 2.0**62).select("id", "label", F.transform("w", lambda x: x.cast("long")).alias("v"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        ends = np.asarray(lists.offsets)
        values = np.asarray(lists.values)[ends[0] : ends[-1]].astype("<i4")
        packed = pa.Array.from_buffers(pa.binary(), len(lists), [None, pa.py_buffer(((ends - ends[0]) * 4).astype(np.int32)), pa.py_buffer(values)])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], packed], ["row", "id", "label", "vector"])


def _read(rows: pa.Table, name: str) -> np.ndarray:
    return np.asarray(rows[name].combine_chunks())


def _matrix(rows: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(rows["vector"].to_pylist()), "<i4").reshape(len(rows), -1).astype(np.int64)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(parent, depth, edge length) of a minimum spanning tree of the rows; the root, its own
    parent, is the row nearest to their mean."""
    x = x.astype(np.float64)
    n, square = len(x), np.einsum("ij,ij->i", x, x)
    root = int(np.argmin(square - 2 * (x @ x.mean(axis=0))))
    parent, depth, edge = np.full(n, root), np.zeros(n, np.int64), np.zeros(n)
    near, done, at = np.full(n, np.inf), np.zeros(n, bool), root
    for _ in range(n):
        done[at] = True
        away = square + square[at] - 2 * (x @ x[at])
        closer = (away < near) & ~done
        near[closer], parent[closer] = away[closer], at
        at = int(np.argmin(np.where(done, np.inf, near)))
        if done[at]:
            break
        depth[at] = depth[parent[at]] + 1
        edge[at] = np.sqrt(np.square(x[at] - x[parent[at]]).sum())
    return parent, depth, edge


def _with_tree(rows: pa.Table) -> pa.Table:
    parent, depth, edge = spanning_tree(_matrix(rows))
    extra = {"place": np.arange(len(rows)), "parent": parent.astype(np.int64), "depth": depth, "edge": edge}
    for name, values in extra.items():
        rows = rows.append_column(name, pa.array(values))
    return rows


class Scores:
    """Scores of a block of anchors with a run of candidates, exact where asked for, else bounded."""

    def __init__(self, anchors: np.ndarray, candidates: np.ndarray, parent: np.ndarray, edge: np.ndarray):
        reach = np.linalg.norm(anchors.astype(np.float64), axis=1).max(initial=0)
        self.norm = np.linalg.norm(candidates.astype(np.float64), axis=1)
        exact = reach * self.norm.max(initial=0) < 2.0**52
        self.a, self.c = (anchors.astype(np.float64), candidates.astype(np.float64)) if exact else (anchors, candidates)
        self.parent, self.edge = parent, edge
        self.low, self.high = np.empty((len(anchors), len(candidates))), np.empty((len(anchors), len(candidates)))
        self.slack = 1e-9 * reach * self.norm

    def bounds(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of anchors whose parents have theirs; a root's are open."""
        width = self.edge[some, None] * self.norm * (1 + 1e-9) + self.slack
        low, high = self.low[self.parent[some]] - width, self.high[self.parent[some]] + width
        root = self.parent[some] == some
        low[root], high[root] = -np.inf, np.inf
        return low, high

    def settle(self, some: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Scores where ``wanted`` (elsewhere 0); the intervals are kept for the children."""
        if wanted.mean() > 0.05:
            score = np.where(wanted, (self.a[some] @ self.c.T).astype(np.int64), 0)
        else:
            score = np.zeros(wanted.shape, np.int64)
            i, j = np.nonzero(wanted)
            for k in range(0, len(i), 1 << 16):
                p, q = i[k : k + (1 << 16)], j[k : k + (1 << 16)]
                score[p, q] = np.einsum("ij,ij->i", self.a[some[p]], self.c[q]).astype(np.int64)
        self.low[some], self.high[some] = np.where(wanted, score, low), np.where(wanted, score, high)
        return score


class Best:
    """The first ``k`` (score, id) per key, higher scores first; ids must arrive in rising order."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.score, self.id = np.full((keys, k), _LEAST), np.full((keys, k), NO_ID)

    @property
    def last(self) -> np.ndarray:
        return self.score[:, -1]

    def add(self, key: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        some, at = np.unique(key, return_inverse=True)
        at = np.concatenate([np.repeat(np.arange(len(some)), self.k), at])
        score = np.concatenate([self.score[some].ravel(), score])
        ident = np.concatenate([self.id[some].ravel(), ident])
        order = np.lexsort((-score, at))  # stable: of equal scores the one that came first
        at, score, ident = at[order], score[order], ident[order]
        rank = np.arange(len(at)) - np.searchsorted(at, at)
        kept = rank < self.k
        self.score[some[at[kept]], rank[kept]] = score[kept]
        self.id[some[at[kept]], rank[kept]] = ident[kept]

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        key, rank = np.nonzero(self.score > _LEAST)
        return key, self.score[key, rank], self.id[key, rank]


def _walk(anchors: pa.Table, candidates: pa.Table, visit: Callable) -> None:
    """Calls ``visit(scores, level, ids, labels, rows)`` for each level of the tree and run of candidates."""
    candidates = candidates.take(np.lexsort((_read(candidates, "row"), _read(candidates, "id"))))
    parent, depth, edge, x = _read(anchors, "parent"), _read(anchors, "depth"), _read(anchors, "edge"), _matrix(anchors)
    levels = [np.flatnonzero(depth == d) for d in range(int(depth.max()) + 1)]
    for start in range(0, len(candidates), STEP):
        run = candidates.slice(start, STEP)
        scores = Scores(x, _matrix(run), parent, edge)
        ids, labels, rows = (_read(run, c) for c in ("id", "label", "row"))
        for level in levels:
            visit(scores, level, ids, labels, rows)


def _find_positives(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        anchors = anchors.take(np.argsort(_read(anchors, "place")))
        own, label = _read(anchors, "row"), _read(anchors, "label")
        best = Best(len(anchors), k)

        def visit(scores, level, ids, labels, rows):
            low, high = scores.bounds(level)
            alike = (label[level, None] == labels) & (own[level, None] != rows)
            wanted = alike & (high > best.last[level, None])
            score = scores.settle(level, low, high, wanted)
            i, j = np.nonzero(wanted & (score > best.last[level, None]))
            best.add(level[i], score[i, j], ids[j])

        if len(anchors) and len(candidates):
            _walk(anchors, candidates, visit)
        key, score, ident = best.rows()
        return pa.table({"anchor": own[key], "score": score, "id": ident})

    return run


def _find_negatives(k: int, low_share: int, high_share: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        anchors = anchors.take(np.argsort(_read(anchors, "place")))
        own, label = _read(anchors, "row"), _read(anchors, "label")
        opened = anchors["windows"].to_pylist()
        width = max((len(w) for w in opened), default=0)
        # Whole numbers inside a share of the positive's score; a missing window is empty.
        lows = np.array([[-(-low_share * s // 100) for s in w] + [1] * (width - len(w)) for w in opened], np.int64).reshape(len(opened), width)
        highs = np.array([[high_share * s // 100 for s in w] + [0] * (width - len(w)) for w in opened], np.int64).reshape(len(opened), width)
        best = Best(len(anchors) * width, k)

        def visit(scores, level, ids, labels, rows):
            low, high = scores.bounds(level)
            other = label[level, None] != labels
            wanted = np.zeros(other.shape, bool)
            floors = [np.maximum(best.last[level * width + w], lows[level, w] - 1)[:, None] for w in range(width)]
            for w in range(width):
                top = highs[level, w][:, None]
                wanted |= (high > floors[w]) & (low <= top) & (lows[level, w][:, None] <= top)
            wanted &= other
            score = scores.settle(level, low, high, wanted)
            for w in range(width):
                i, j = np.nonzero(wanted & (score > floors[w]) & (score <= highs[level, w][:, None]))
                best.add(level[i] * width + w, score[i, j], ids[j])

        if len(anchors) and len(candidates) and width:
            _walk(anchors, candidates, visit)
        key, score, ident = best.rows()
        return pa.table({"anchor": own[key // max(width, 1)], "window": key % max(width, 1) + 1, "score": score, "id": ident})

    return run


def _id(column: str) -> Column:
    return F.when(F.col(column) != NO_ID, F.col(column))


def hard_negatives(
    table: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low_share: int = 50, high_share: int = 95
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``table`` has (id, label, vector); ``anchor`` says which ids are anchors. An anchor's positives
    are its best other rows of the same label. A positive opens a window from ``low_share`` to
    ``high_share`` per cent of its score, whose best rows of other labels are its negatives.
    """
    rows = integers(table).distinct().withColumn("row", F.monotonically_increasing_id())
    rows = rows.select("row", F.coalesce("id", F.lit(NO_ID)).alias("id"), "label", "v")
    rows = stage(rows.mapInArrow(_pack, _ROW).withColumn("size", F.length("vector")))
    chosen = F.coalesce(anchor & (F.col("id") != NO_ID), F.lit(False))
    sizes = rows.groupBy("size").agg(F.count(F.lit(1)).alias("n"), F.count_if(chosen).alias("anchors"))
    few = F.least(F.lit(SPREAD), F.ceil(F.col("n") / 512))
    sizes = sizes.select(
        "size", F.ceil(F.col("anchors") / ANCHORS).cast("int").alias("a_blocks"), F.greatest(F.ceil(F.col("n") / CANDIDATES), few).cast("int").alias("c_blocks")
    ).where("a_blocks > 0")
    dealt = rows.join(sizes, "size")
    block = lambda of: F.pmod(F.xxhash64("row"), F.col(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.col(of) - 1))

    own = dealt.where(chosen).withColumn("a", block("a_blocks")).select("row", "id", "label", "vector", "size", "a", "c_blocks")
    kinds = own.schema.simpleString()[len("struct<") : -1].replace(":", " ")
    anchors = stage(own.groupBy("size", "a").applyInArrow(_with_tree, f"{kinds}, place long, parent long, depth long, edge double"))
    candidates = dealt.select("row", "id", "label", "vector", "size", block("c_blocks").alias("c"), every("a_blocks").alias("a"))

    def meet(left: DataFrame, find: Callable, schema: str) -> DataFrame:
        left = left.withColumn("c", every("c_blocks")).drop("c_blocks")
        pair = ("size", "a", "c")
        return left.groupBy(*pair).cogroup(candidates.groupBy(*pair)).applyInArrow(find, schema)

    def first(found: DataFrame, most: int, *key: str) -> DataFrame:
        w = Window.partitionBy(*key).orderBy(F.desc("score"), "id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= most)

    found = meet(anchors, _find_positives(positives), "anchor long, score long, id long")
    best = stage(first(found, positives, "anchor"))
    ranked = F.array_sort(F.collect_list(F.struct("rank", "score")))
    windows = best.groupBy("anchor").agg(ranked["score"].alias("windows")).withColumnRenamed("anchor", "row")
    found = meet(anchors.join(windows, "row"), _find_negatives(negatives, low_share, high_share), "anchor long, window long, score long, id long")
    nearest = first(found, negatives, "anchor", "window")
    opened = best.select("anchor", F.col("rank").cast("long").alias("window"), F.col("id").alias("positive"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return nearest.join(opened, ["anchor", "window"]).join(named, "anchor").select(
        "anchor_id", _id("positive").alias("positive_id"), "rank", _id("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def brute_force(rows: list[tuple], anchor: Callable, positives: int, negatives: int, low_share: int, high_share: int) -> list[tuple]:
    """The same from whole rows (id, label, list of integers), all pairs; for tests."""
    rows = list(dict.fromkeys((i, label, tuple(v)) for i, label, v in rows))
    dot = lambda x, y: sum(p * q for p, q in zip(x, y, strict=True))
    out = []
    for a in rows:
        if a[0] is None or not anchor(a[0]):
            continue
        scored = [(-dot(a[2], b[2]), NO_ID if b[0] is None else b[0], b[1]) for b in rows if b is not a and len(b[2]) == len(a[2])]
        scored.sort()
        for s, i, _ in [x for x in scored if x[2] == a[1]][:positives]:
            inside = [x for x in scored if x[2] != a[1] and low_share * -s <= 100 * -x[0] <= high_share * -s]
            named = lambda x: None if x == NO_ID else x
            out += [(a[0], named(i), k + 1, named(x[1]), -s, -x[0]) for k, x in enumerate(inside[:negatives])]
    return out
