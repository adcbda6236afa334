"""Candidate buckets, coarse groups and exact counting in blocks, for joins of similar items.

Items (nodes) that share a bucket may be similar. Buckets of at most ``LIMIT`` nodes are compared
pair by pair in memory; a larger one, dense as its makers see to it, is taken as one group
unseen. Groups connected so hold every candidate pair, and are then compared exactly: a group
is dealt into blocks by hash, a task gets two blocks, and gives the links it finds as counts per
node and as a spanning forest, never as pairs. Work grows with the square of a group of similar
items, which is the number of its links, but it is spread over blocks of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import components, forest, stage

#: Nodes of a bucket compared in memory; nodes of a block; rows of a task.
LIMIT, BLOCK, TASK_ROWS = 200, 512, 20_000

#: Gets the rows of two blocks (indices of the first, indices of the second or None if it is the
#: same), and gives pairs as two index arrays.
Compare = Callable[[pa.Table, np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray]]


def sized_buckets(members: DataFrame) -> DataFrame:
    """(path, node, size) of buckets with two nodes or more, of equal buckets only one."""
    hashed = F.xxhash64("node").cast("decimal(38,0)")
    sizes = members.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.sum(hashed).alias("set")).where("size >= 2")
    one = sizes.groupBy("size", "set").agg(F.min("path").alias("path"))
    return members.join(one.select("path", "size"), "path")


def bucket_edges(buckets: DataFrame, payload: DataFrame, column: str, alike: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """(a, b) that connect the nodes of small buckets that ``alike`` takes for similar.

    ``payload`` has (node, ``column`` binary); ``alike`` compares rows of two equally long
    matrices of bytes, so nodes whose bytes differ in number are never alike.
    """
    small = buckets.where(f"size <= {LIMIT}")
    n = small.count()
    if not n:
        return small.select(F.col("node").alias("a"), F.col("node").alias("b"))
    shards = max(1, n // TASK_ROWS)

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(np.asarray(table["path"].combine_chunks()), kind="stable")
        path, node = np.asarray(table["path"].combine_chunks())[order], np.asarray(table["node"].combine_chunks())[order]
        held = table[column].combine_chunks()
        rows = np.frombuffer(held.buffers()[2], np.uint8)[held.offset * len(held[0].as_buffer()) :][: len(held) * len(held[0].as_buffer())]
        rows = rows.reshape(len(held), -1)[order]
        left, right = [], []
        for step in range(1, LIMIT):
            first = np.flatnonzero(path[:-step] == path[step:])
            if not len(first):
                break
            for i in range(0, len(first), 1 << 15):
                part = first[i : i + (1 << 15)]
                hit = part[alike(rows[part], rows[part + step])]
                left.append(node[hit]), right.append(node[hit + step])
        left, right = np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right])
        found = forest(left.tolist(), right.tolist())
        pairs = [(a, b) for a, b in found.items() if a != b]
        return pa.table({"a": pa.array([a for a, _ in pairs], pa.int64()), "b": pa.array([b for _, b in pairs], pa.int64())})

    with_rows = small.join(payload, "node").withColumn("shard", F.pmod("path", F.lit(shards)))
    return with_rows.select("shard", "path", "node", column).groupBy("shard", F.length(column)).applyInArrow(run, "a long, b long")


def coarse_groups(edges: DataFrame, dense: DataFrame) -> DataFrame:
    """(node, group): connected by ``edges`` (a, b) or by a bucket of ``dense`` (path, node)."""
    least = dense.groupBy("path").agg(F.min("node").alias("b"))
    star = dense.join(least, "path").select(F.col("node").alias("a"), "b")
    return components(edges.union(star)).withColumnRenamed("component", "group")


def exact_links(groups: DataFrame, payload: DataFrame, compare: Compare) -> tuple[DataFrame, DataFrame]:
    """Links within groups: (node, links), links being the copies (c) of all linked nodes, and
    edges (a, b) that connect linked nodes. ``payload`` has node, c and what ``compare`` reads."""
    sizes = groups.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own = groups.join(sizes, "group").select("node", "group", blocks.alias("blocks")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = stage(dealt.withColumn("pair", F.xxhash64("group", F.least("own", "other"), F.greatest("own", "other"))).select("node", "own", "pair", (F.col("own") == F.col("other")).alias("same")))
    shards = max(1, dealt.count() // 1_000)
    rows = dealt.join(payload, "node").withColumn("shard", F.pmod("pair", F.lit(shards)))

    def run(table: pa.Table) -> pa.Table:
        pair, own = np.asarray(table["pair"].combine_chunks()), np.asarray(table["own"].combine_chunks())
        node, c = np.asarray(table["node"].combine_chunks()), np.asarray(table["c"].combine_chunks())
        same = np.asarray(table["same"].combine_chunks().cast(pa.int8())) == 1
        order = np.lexsort((own, pair))
        cuts = np.flatnonzero(np.diff(pair[order])) + 1
        links, left, right = np.zeros(len(node), np.int64), [], []
        for part in np.split(order, cuts) if len(order) else []:
            edge = np.flatnonzero(np.diff(own[part]))
            if len(edge):
                x, y = compare(table, part[: edge[0] + 1], part[edge[0] + 1 :])
            elif len(part) and same[part[0]]:
                x, y = compare(table, part, None)
            else:  # the other block is empty
                continue
            np.add.at(links, x, c[y])
            np.add.at(links, y, c[x])
            joined = forest(node[x].tolist(), node[y].tolist())
            left += joined.keys()
            right += joined.values()
        some = np.flatnonzero(links)
        return pa.table(
            {
                "node": pa.array(np.concatenate([node[some], np.array(left, np.int64)])),
                "links": pa.array(np.concatenate([links[some], np.zeros(len(left), np.int64)])),
                "other": pa.array(np.concatenate([node[some], np.array(right, np.int64)])),
            }
        )

    found = stage(rows.groupBy("shard").applyInArrow(run, "node long, links long, other long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    return counts, found.where("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b"))


def batched(make: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield make(batch)

    return run
