"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, multiprobed.

Vectors are scaled to length one and rotated by three rounds of random signs and a fast
Hadamard transform; the largest coordinate, with its sign, is the hash. A table joins ``width``
hashes, as many as keep unrelated vectors apart at the given number of vectors, and probes the
next best coordinates too. Vectors that meet in a bucket are candidates; they are verified by
cosine in double precision, in groups (see ``groups``), so that no link is reported below the
threshold and a group of similar vectors is never spelt out as pairs.

Defined results: equal vectors are one node, counted with their copies. A vector that is null,
zero, or holds a null or non-finite component links with nothing, as do vectors of different
lengths. Repeated vec_ids count as different vectors; a null vec_id gets its own null component
unless a linked vector has an id. Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import components, stage
from feedlake.llm.groups import LIMIT, batched, bucket_edges, coarse_groups, exact_links, sized_buckets
from feedlake.llm.words import mix

TABLES, PROBES = 16, 4


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / math.sqrt(n)


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return x


def buckets_of(x: np.ndarray, width: int) -> np.ndarray:
    """(rows, TABLES * PROBES) bucket numbers of unit vectors.

    The first probe takes the best coordinate in every hash of the table. The others replace one
    coordinate by the next best: those replacements that lose the least.
    """
    wide = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, wide - x.shape[1])))
    n, out = len(x), []
    for table in range(TABLES):
        best, second, loss = [], [], []
        for j in range(width):
            y = rotate(x, 1_000 * table + j)
            top = np.argpartition(-np.abs(y), 1, axis=1)[:, :2]
            height = np.abs(np.take_along_axis(y, top, 1))
            swap = height[:, 1] > height[:, 0]
            top[swap] = top[swap][:, ::-1]
            code = 2 * top + (np.take_along_axis(y, top, 1) > 0)
            best.append(code[:, 0]), second.append(code[:, 1])
            loss.append(np.abs(height[:, 0] - height[:, 1]))
        best, second, loss = np.array(best), np.array(second), np.array(loss)
        # Each choice of hashes to replace, by its total loss; the empty choice loses nothing.
        choices = np.array([[c >> j & 1 for j in range(width)] for c in range(1 << width)])
        order = np.argsort((choices @ loss).T, axis=1, kind="stable")[:, :PROBES]
        for p in range(order.shape[1]):
            pick = choices[order[:, p]].T
            code = np.where(pick == 1, second, best).astype(np.uint64)
            key = np.full(n, table, np.uint64)
            for j in range(width):
                key = mix(key * np.uint64(1 << 20) + code[j] + np.uint64(1))
            out.append(key.view(np.int64))
    return np.stack(out, axis=1)


def near_vectors(table: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Per row: (vec_id, n_links, component_id, kept)."""
    vector = F.col("embedding").cast("array<double>")
    sound = F.size("v") > 0
    sound &= ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))) & F.exists("v", lambda c: c != 0)
    rows = stage(table.select("vec_id", vector.alias("v")).withColumn("ok", F.coalesce(sound, F.lit(False))))
    nodes = stage(
        rows.where("ok").groupBy("v").agg(F.count(F.lit(1)).alias("c"), F.min("vec_id").alias("least_id")).withColumn("node", F.xxhash64("v", F.size("v")))
    )
    n = nodes.count()

    def pack(batch: pa.RecordBatch) -> pa.RecordBatch:
        unit = []
        for x in batch.column(1):
            y = np.array(x.as_py(), np.float64)
            y = y / np.abs(y).max()
            unit.append((y / math.sqrt(y @ y)).tobytes())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(unit, pa.binary()), batch.column(2)], ["node", "unit", "c"])

    packed = stage(nodes.select("node", "v", "c").mapInArrow(batched(pack), "node long, unit binary, c long"))

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        node, units = np.asarray(batch.column(0)), batch.column(1).to_pylist()
        path, owner = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        sizes = np.array([len(u) for u in units])
        for size in np.unique(sizes):
            some = np.flatnonzero(sizes == size)
            x = np.frombuffer(b"".join(units[i] for i in some), np.float64).reshape(len(some), -1)
            # As many hashes as give each vector a bucket or more.
            places = 2 * (1 << max(1, (x.shape[1] - 1).bit_length()))
            width = min(8, max(1, math.ceil(math.log(max(n, 2)) / math.log(places) - 0.25)))
            keys = buckets_of(x, width)
            path.append(mix(keys.ravel().view(np.uint64) ^ np.uint64(size)).view(np.int64))
            owner.append(np.repeat(node[some], keys.shape[1]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(path)), pa.array(np.concatenate(owner))], ["path", "node"])

    def close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", x.view(np.float64), y.view(np.float64)) >= threshold

    def compare(rows: pa.Table, first: np.ndarray, second: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        held = rows["unit"].combine_chunks()
        read = lambda part: np.frombuffer(b"".join(held[int(i)].as_buffer().to_pybytes() for i in part), np.float64).reshape(len(part), -1)
        x = read(first)
        y = x if second is None else read(second)
        i, j = np.nonzero(x @ y.T >= threshold)
        if second is None:
            i, j = i[i < j], j[i < j]
        return first[i], (first if second is None else second)[j]

    members = packed.select("node", "unit").mapInArrow(batched(hashed), "path long, node long")
    buckets = stage(sized_buckets(members.distinct()))
    edges = bucket_edges(buckets, packed.select("node", "unit"), "unit", close)
    groups = stage(coarse_groups(edges, buckets.where(f"size > {LIMIT}").select("path", "node")))
    counts, links = exact_links(groups, packed, compare)
    placed = nodes.join(counts, "node", "left").join(components(links), "node", "left").select("v", "c", "links", "least_id", F.coalesce("component", "node").alias("part"))
    ids = placed.groupBy("part").agg(F.min("least_id").alias("component_id"))
    named = placed.join(ids, "part").select("v", "component_id", (F.coalesce("links", F.lit(0)) + F.col("c") - 1).alias("links"))
    out = rows.where("ok").join(named, "v").select("vec_id", F.col("links").alias("n_links"), "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))
