"""Changes between two snapshots of a table, as a change feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedlake.functions.expressions import all_of, any_null, none_null

#: Groups of keys whose rows are summed up before any row moves; as many rows go to every task.
DIGESTS = 4096
_GROUP = "_fl_digest"


def _group(df: DataFrame, like: DataFrame, keys: list[str], groups: int) -> Column:
    """Which group a row is in, by its keys as ``like`` has them."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast(like.schema[k].dataType) for k in keys]), F.lit(groups))


def digests(df: DataFrame, like: DataFrame, keys: list[str], groups: int = DIGESTS) -> DataFrame:
    """(group, rows, two sums over hashes of whole rows) of ``df``, its columns as ``like`` has them.

    Summed up in every map task first, so what moves does not grow with the table. Nulls count by
    their place. Equal sums stand for equal rows; that they do not has a chance of about 2**-120.
    """
    parts = []
    for field in like.schema.fields:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        nested = field.dataType.typeName() in ("struct", "array", "map", "variant")
        parts += [F.to_json(F.struct(value.alias("v")), {"ignoreNullFields": "false"}) if nested else value, value.isNull()]

    def total(*seed: Column) -> Column:
        return F.sum(F.xxhash64(*seed, *parts).cast("decimal(38,0)"))

    return df.groupBy(_group(df, like, keys, groups).alias(_GROUP)).agg(
        F.count(F.lit(1)).alias("rows"), total().alias("sum_a"), total(F.lit("again")).alias("sum_b")
    )


def changed_groups(old: DataFrame, new: DataFrame, keys: list[str], groups: int = DIGESTS) -> DataFrame:
    """The groups of keys in which the snapshots differ, ``groups`` rows at most."""
    a = digests(old, new, keys, groups).select(F.col(_GROUP).alias("g"), F.struct("rows", "sum_a", "sum_b").alias("a"))
    b = digests(new, new, keys, groups).select(F.col(_GROUP).alias("h"), F.struct("rows", "sum_a", "sum_b").alias("b"))
    both = a.join(b, F.col("g") == F.col("h"), "full_outer")
    return both.filter(~F.col("a").eqNullSafe(F.col("b"))).select(F.coalesce("g", "h").alias(_GROUP))


def snapshot_diff(
    old: DataFrame, new: DataFrame, keys: list[str], ts_ms: int | Column, full_load: bool = False, groups: int = DIGESTS
) -> DataFrame:
    """Envelope rows that turn ``old`` into ``new``: c, u and d, or r for a full load.

    Rows are first summed up by groups of keys; only those of groups that differ move. So two equal
    snapshots are compared without moving a row, at the price of a second scan; a diff that moves
    nothing anyway, of snapshots bucketed by the keys, goes without. See ``compare`` for the rest;
    a key that repeats alike in both snapshots is not seen in a group that does not differ.
    """
    plain = compare(old, new, keys, ts_ms, full_load)
    if not groups or "Exchange" not in plain._jdf.queryExecution().executedPlan().toString():
        return plain
    # As many rows as there are groups, however large the tables.
    changed = F.broadcast(changed_groups(old, new, keys, groups))

    def left(df: DataFrame) -> DataFrame:
        named = df.withColumn(_GROUP, _group(df, new, keys, groups))
        return named.join(changed, _GROUP, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])

    return compare(left(old), left(new), keys, ts_ms, full_load)


def compare(old: DataFrame, new: DataFrame, keys: list[str], ts_ms: int | Column, full_load: bool = False) -> DataFrame:
    """Envelope rows that turn ``old`` into ``new``: c, u and d, or r for a full load.

    A key that repeats in a snapshot raises SNAPSHOT_KEY_REPEATED: each side is reduced to a row
    per key before it moves, so no key's rows meet or are paired in one task. Equal rows give no change. Rows with a null key
    cannot be paired: they come out as d (old) and c (new) without passing the join. Two
    snapshots bucketed by the keys are compared without an exchange.
    """
    columns = new.columns
    when = ts_ms if isinstance(ts_ms, Column) else F.lit(ts_ms)
    row_type = new.select(F.struct(*columns).alias("row")).schema["row"].dataType

    def image(df: DataFrame, name: str) -> DataFrame:
        # The keys also stand beside the row, plain, so a bucketed side keeps its place.
        row = F.struct(*[F.col(f"`{c}`").cast(new.schema[c].dataType).alias(c) for c in columns])
        return df.select(*[F.col(f"`{k}`").alias(f"{name}_k{i}") for i, k in enumerate(keys)], row.alias(name))

    def unique(df: DataFrame, name: str) -> DataFrame:
        own = image(df.filter(none_null(keys)), name)
        key = [f"{name}_k{i}" for i in range(len(keys))]
        counted = own.groupBy(*key).agg(F.first(name).alias(name), F.count(F.lit(1)).alias("_fl_rows"))
        repeated = F.concat(F.lit("SNAPSHOT_KEY_REPEATED: "), F.to_json(F.struct(*key)))
        fine = F.when(F.col("_fl_rows") > 1, F.raise_error(repeated).cast("boolean")).otherwise(True)
        return counted.filter(fine).drop("_fl_rows")

    def events(df: DataFrame, op: Column) -> DataFrame:
        images = [
            (F.col(n) if n in df.columns else F.lit(None)).cast(row_type).alias(n) for n in ("after", "before")
        ]
        return df.select(*images, op.alias("op"), when.cast("long").alias("ts_ms"))

    insert = F.lit("r" if full_load else "c")
    before, after = F.col("before"), F.col("after")
    pairs = unique(old, "before").join(
        unique(new, "after"),
        all_of(F.col(f"before_k{i}") == F.col(f"after_k{i}") for i in range(len(keys))),
        "full_outer",
    )
    op = F.when(before.isNull(), insert).when(after.isNull(), "d").otherwise("u")
    return (
        events(pairs.filter(~before.eqNullSafe(after)), op)
        .unionByName(events(image(new.filter(any_null(keys)), "after"), insert))
        .unionByName(events(image(old.filter(any_null(keys)), "before"), F.lit("d")))
    )
