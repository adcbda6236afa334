"""What the operators share: scratch tables, connected components, columns by position of need."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def scratch(spark: SparkSession) -> str:
    """A fresh folder that driver and executors share: under ``spark.checkpoint.dir``, or,
    where that is unset, under the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stage(df: DataFrame, **options: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here, and a lost
    executor loses none of it. ``options`` are those of the writer."""
    path = scratch(df.sparkSession)
    df.write.options(compression="zstd", **options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow(df: DataFrame, *columns: str) -> DataFrame:
    """Only ``columns``, so that further columns of the input can't clash with those made here."""
    return df.select(*(F.col(f"`{c}`").alias(c) for c in columns))


_kept: list[Callable[[], None]] = []


def keeps(clear: Callable[[], None]) -> None:
    """Says how to let go of what an operator keeps in a Python worker between its tasks."""
    _kept.append(clear)


def give_back() -> None:
    """Gives memory that a Python worker no longer uses back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim is not None:
        trim(0)


def release() -> None:
    """For a task of another operator: lets go of all that, and gives the memory back."""
    for clear in _kept:
        clear()
    if _kept:
        give_back()


def free(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _summary(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of ``edges`` as (node, component), component the smallest node.

    Nodes without an edge, and edges from a node to itself or to null, give no row. Alternates
    the large-star and small-star steps (Kiveris et al., 2014): each is an aggregate by node,
    combined before the shuffle, and an inner join that adaptive execution can split, so no
    node's edges ever meet in one task. Ends when a round changes nothing.
    """
    e = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    e = stage(e.select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct())
    before = _summary(e)
    while before[0]:
        both = e.union(e.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.union(low.select("u", F.col("m").alias("v"))).distinct())
        after = _summary(e)
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v"), F.col("v")).distinct()
    )


def forest(left: Sequence[int], right: Sequence[int]) -> dict[int, int]:
    """Union-find over the pairs of one bounded block: node -> smallest node it is joined to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(left, right, strict=True):
        p, q = root(x), root(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
    return {x: root(x) for x in parent}
