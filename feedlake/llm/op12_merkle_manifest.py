"""Merkle manifest of a dataset: a hash tree per source, one over the sources, and proofs.

Leaves are numbered by one global sort. A tree is built from blocks of 3**4 = 81 consecutive
nodes: one grouping climbs four levels, so the built levels are stored as node rows that hold a
node's siblings on those four levels and point at the node four levels up, in the last block of
a source at its leaf in the tree over the sources. A recursive query then ascends from every
leaf along those rows, appends the siblings and folds the hash that it started with. The rows of
leaves are where it starts; what it joins are the rows above them, an 81st of the leaves.

No key meets in one task however large a source is: the sort deals a source, and rows equal in
all columns too, over many partitions; a block is 81 nodes; and a node that many leaves pass on
their way up stands in as many copies as leaves below it / ``SHARE``, each leaf using one.

Defined results: nulls hash as ``-``; an empty text as ``0:``. Null sources are one source, the
first; null doc_ids come first in their source, are never altered, and rows with equal doc_ids
stand in the order of their leaves. Repeated rows are leaves of their own. An empty table has no
root and gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlake.llm.common import narrow, stage

#: Nodes of a run, levels climbed by one row, leaves that use one copy of a node row.
ARITY, LEVELS, SHARE = 3, 4, 2_000
BLOCK = ARITY**LEVELS
#: Rows of a task of frames much smaller than the leaves.
TASK_ROWS = 100_000
#: The tree over the sources.
TOP = -1


def field(value: Column) -> Column:
    """``-`` for null, else byte count, colon, value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column) -> Column:
    """The digest, binary as all that are stored; it is hashed as hex text."""
    parts = (field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars"))
    return F.unhex(F.sha2(F.concat(*parts, field(text)), 256))


def hex_text(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def without_newlines(docs: DataFrame) -> Column:
    """The text as tampered with: in documents with an even checksum of their id, without newlines."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))


def _few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, of ``rows`` rows at most, in tasks of no less than ``TASK_ROWS``."""
    return df.coalesce(1 + rows // TASK_ROWS)


def _runs(ordered: DataFrame, group: Column) -> DataFrame:
    """(g, part, first, before, n): where the run that each partition of ``ordered`` holds of a
    group begins, and how many rows of the group lie before it and in all."""
    runs = ordered.groupBy(group.alias("g"), F.shiftright("m", 33).alias("part")).agg(F.min("m").alias("first"), F.count(F.lit(1)).alias("size"))
    w = Window.partitionBy("g")
    before = F.sum("size").over(w.orderBy("part")) - F.col("size")
    return runs.select("g", "part", "first", before.alias("before"), F.sum("size").over(w).alias("n"))


def _sorted(df: DataFrame, *order: str) -> DataFrame:
    return stage(df.orderBy(*order).withColumn("m", F.monotonically_increasing_id()))


def numbered(df: DataFrame, group: str, *order: str) -> DataFrame:
    """``df`` with ``pos``, counted from 0 in each group by ``order``, the group's size ``n`` and
    its own number ``tree`` among the groups; nulls are a group. ``order`` has no large ties.

    One global sort gives every partition a run of each group; where a run begins follows from
    the sizes of the runs, of which a group has one a partition at most.
    """
    ordered = _sorted(df, group, *order)
    most = ordered.count()
    runs = stage(_few(_runs(ordered, F.col(group)), most))
    groups = _sorted(_few(runs.select("g").distinct(), most), "g")
    numbers = groups.join(stage(_few(_runs(groups, F.lit(0)).drop("g"), most)), F.shiftright("m", 33) == F.col("part"))
    numbers = numbers.select(F.col("g").alias("name"), (F.col("m") - F.col("first") + F.col("before")).alias("tree"))
    runs = stage(_few(runs.join(numbers, F.col("g").eqNullSafe(F.col("name"))), most))
    joined = ordered.join(runs, F.col(group).eqNullSafe(F.col("g")) & (F.shiftright("m", 33) == F.col("part")))
    return joined.select(*df.columns, "tree", "n", (F.col("m") - F.col("first") + F.col("before")).alias("pos"))


def _hashes(nodes: Column) -> Column:
    """The next level: a hash for every run of three."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, ARITY), ""), 256))


def _grow(nodes: DataFrame, number: int, count: int) -> DataFrame:
    """Node rows of one storey: ``nodes`` (tree, pos, n, hash, leaves, own) and the way up from each."""
    packed = nodes.groupBy("tree", F.floor(F.col("pos") / BLOCK).alias("block")).agg(
        F.max("n").alias("n"),
        F.sum("leaves").alias("up_leaves"),
        F.sort_array(F.collect_list(F.struct("pos", "hash", "leaves", "own"))).alias("members"),
    )
    size = F.size("members")
    # A tree with more than one block needs all levels; the only block ends at a single node.
    steps = reduce(lambda c, k: c.when(size <= ARITY**k, k), range(1, LEVELS), F.when(F.col("n") > BLOCK, LEVELS).when(size == 1, 0))
    packed = packed.withColumn("steps", steps.otherwise(LEVELS)).withColumn("level0", F.transform("members.hash", hex_text))
    for k in range(LEVELS):
        packed = packed.withColumn(f"level{k + 1}", F.when(F.col("steps") > k, _hashes(F.col(f"level{k}"))).otherwise(F.col(f"level{k}")))
    rows = packed.select("*", F.posexplode("members").alias("i", "member"))

    def siblings(k: int) -> Column:
        at = F.floor(F.col("i") / ARITY**k).cast("int")
        here, level = at % ARITY, F.col(f"level{k}")
        left, right = F.slice(level, at - here + 1, here), F.slice(level, at + 2, F.lit(ARITY - 1) - here)
        return F.struct(F.unhex(F.array_join(left, "")).alias("l"), F.unhex(F.array_join(right, "")).alias("r"))

    last = F.col("n") <= BLOCK
    top = F.col("tree") == TOP
    return stage(
        _few(rows, 8 * count).select(
            "tree",
            F.lit(number).alias("storey"),
            F.col("member.pos").alias("pos"),
            F.col("member.leaves").alias("leaves"),
            F.col("member.own").alias("own"),
            F.col("member.hash").alias("hash"),
            "n",
            F.slice(F.array(*(siblings(k) for k in range(LEVELS))), F.lit(1), F.col("steps")).alias("path"),
            F.unhex(F.element_at(f"level{LEVELS}", 1)).alias("up"),
            "up_leaves",
            F.when(~last, F.col("tree")).when(~top, F.lit(TOP)).cast("long").alias("up_tree"),
            F.when(last, 0).otherwise(number + 1).alias("up_storey"),
            F.when(last, F.col("tree")).otherwise(F.col("block")).cast("long").alias("up_pos"),
        )
    )


def build(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Node rows over ``leaves`` (tree, pos, n, hash, own): those of the leaves, and all above."""
    storeys, ends = [], []

    def raise_up(nodes: DataFrame, count: int) -> None:
        number = 0
        while count:
            rows = _grow(nodes, number, count)
            storeys.append(rows)
            ends.append(rows.where(f"n <= {BLOCK} and pos = 0"))
            nodes = rows.where(f"n > {BLOCK} and pos % {BLOCK} = 0").select(
                "tree",
                F.col("up_pos").alias("pos"),
                F.ceil(F.col("n") / BLOCK).alias("n"),
                F.col("up").alias("hash"),
                F.col("up_leaves").alias("leaves"),
                F.lit(None).alias("own"),
            )
            number, count = number + 1, nodes.count()

    raise_up(leaves.withColumn("leaves", F.lit(1).cast("long")), max(1, leaves.count()))
    subroots = reduce(DataFrame.union, (rows.select("tree", "up", "up_leaves") for rows in ends))
    sources = subroots.count()
    tops = subroots.select(
        F.lit(TOP).cast("long").alias("tree"),
        F.col("tree").alias("pos"),
        F.lit(sources).alias("n"),
        F.col("up").alias("hash"),
        F.col("up_leaves").alias("leaves"),
        F.lit(None).alias("own"),
    )
    raise_up(tops, max(1, sources))
    return storeys[0], reduce(DataFrame.union, (rows.drop("own", "hash") for rows in storeys[1:]))


#: One row's way up: the hash folded with the siblings, the siblings, and where it leads.
_FOLD = "aggregate({path}, {hash}, (h, s) -> unhex(sha2(lower(hex(concat(s.l, h, s.r))), 256)))"
_APPEND = "aggregate({path}, {proof}, (p, s) -> concat(p, s.l, s.r))"
_UP = f"""coalesce({{subroot}}, case when n.up_tree = {TOP} and n.tree <> {TOP} then n.up end),
    case when n.up_tree is null then n.up end, n.up_tree, n.up_storey, n.up_pos, pmod(xxhash64({{row}}), n.up_copies)"""
#: All joins are of one kind at every size: what moves then grows with the leaves alone.
_CLIMB = f"""
with recursive climb(row, home, block, hash, proof, subroot, root, tree, storey, pos, copy) as (
    select n.own.row, n.tree, n.pos div {BLOCK}, {_FOLD.format(path="n.path", hash="n.own.altered")},
        case when n.pos % {BLOCK} = 0 then cast(X'' as binary) end, {_UP.format(subroot="cast(null as binary)", row="n.own.row")}
    from {{starts}} n
    union all
    select /*+ merge(n) */ c.row, c.home, c.block, {_FOLD.format(path="n.path", hash="c.hash")},
        {_APPEND.format(path="n.path", proof="c.proof")}, {_UP.format(subroot="c.subroot", row="c.row")}
    from climb c join {{nodes}} n on c.tree = n.tree and c.storey = n.storey and c.pos = n.pos and c.copy = n.copy
)
select row, home, block, hash, proof, subroot, root from climb where tree is null limit all
"""


def climb(starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, leaf, folded_root, siblings, subroot, root) from the rows of leaves up to the root.

    Every leaf ascends with its ``own.altered`` and folds it. The siblings above a block are the
    same for all of it: its first leaf appends them, and the others take them over at the end, each
    after the siblings inside the block. ``subroot`` and ``root`` are those that were built.
    """
    copies = lambda leaves: F.ceil(F.col(leaves) / SHARE)
    rows, nodes = (x.withColumn("up_copies", copies("up_leaves")) for x in (starts, nodes))
    nodes = nodes.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies("leaves") - 1)))
    ended = stage(starts.sparkSession.sql(_CLIMB, starts=rows, nodes=nodes))
    above = ended.where(F.col("proof").isNotNull()).select("home", "block", "proof", "subroot", "root")
    here = starts.select(
        "own.doc_id",
        "own.row",
        F.col("hash").alias("leaf"),
        F.col("tree").alias("home"),
        F.floor(F.col("pos") / BLOCK).alias("block"),
        F.expr(_APPEND.format(path="path", proof="cast(X'' as binary)")).alias("inside"),
    )
    folded = ended.select("row", F.col("hash").alias("folded"))
    found = here.join(folded.hint("merge"), "row").join(above.hint("merge"), ["home", "block"])
    return found.select(
        "doc_id",
        hex_text(F.col("leaf")).alias("leaf"),
        hex_text(F.col("folded")).alias("folded_root"),
        hex_text(F.concat("inside", "proof")).alias("siblings"),
        hex_text(F.col("subroot")).alias("subroot"),
        hex_text(F.col("root")).alias("root"),
    )


def manifest(docs: DataFrame) -> DataFrame:
    """Per row: (doc_id, leaf, subroot, root, siblings, folded_root, verified)."""
    docs = narrow(docs, "doc_id", "source", "lang", "n_chars", "text")
    hashed = docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), leaf(without_newlines(docs)).alias("altered"))
    # The number of the row settles ties, so that rows equal in all columns spread, too.
    leaves = numbered(stage(hashed.withColumn("row", F.monotonically_increasing_id())), "source", "doc_id", "leaf", "row")
    own = F.struct("doc_id", "row", "altered")
    leaves = stage(leaves)
    starts, nodes = build(leaves.select("tree", "pos", "n", F.col("leaf").alias("hash"), own.alias("own")))
    return climb(starts, nodes).withColumn("verified", F.col("folded_root") == F.col("root"))
