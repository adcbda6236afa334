"""Bring a table up to date with a batch of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from feedlake.functions.expressions import all_of, any_null, fits_broadcast, gather, none_null
from feedlake.operators.flatten import (
    CONTROL_COLUMNS,
    DELETE_OPS,
    UPSERT_OPS,
    drop_control,
    flatten,
    upserts,
)
from feedlake.operators.latest import first_per_key, latest_per_key, same_group, settle
from feedlake.operators.merge import CARDINALITY_ERROR, MergeBuilder, merge
from feedlake.operators.pruning import bitmap, prunes, split
from feedlake.operators.rowchanges import ACTION, DELETED, INSERTED, KEPT, UPDATED, resolve
from feedlake.plans.table import LakeTable

IS_DELETE, TIED = "_fl_is_delete", "_fl_tied"
_KEY, _ROW, _TIME, _GUARD = "_fl_key", "_fl_row", "_fl_time", "_fl_guard"


def as_changes(feed: DataFrame) -> DataFrame:
    """Flat changes, from an envelope feed or from changes that are flat already."""
    return flatten(feed) if {"after", "before"} <= set(feed.columns) else feed


def _flagged(feed: DataFrame, ts: str) -> DataFrame:
    """The changes that have a time: row columns, time and ``_fl_is_delete``."""
    changes = as_changes(feed)
    changes = changes.filter(F.col("op").isin(UPSERT_OPS + DELETE_OPS) & F.col(ts).isNotNull())
    row = [c for c in changes.columns if c not in CONTROL_COLUMNS or c == ts]
    return changes.select(*row, F.col("op").isin(DELETE_OPS).alias(IS_DELETE))


def reduce_changes(feed: DataFrame, keys: list[str], ts: str = "ts_ms", tie_break=None) -> DataFrame:
    """One change per key, its newest, with ``_fl_is_delete`` and ``_fl_tied``.

    Found in one pass: at most two rows of a key leave a map task. A delete wins a tie. Of tied
    upserts one row stands for all, and ``_fl_tied`` says that there are others; with
    ``tie_break`` it is the row that counts, and none is tied. Rows without a complete key are
    a group like others, of which only upserts count.
    """
    flagged = _flagged(feed, ts)
    keyless = any_null(keys)
    order = [F.col(ts).desc(), F.when(keyless, ~F.col(IS_DELETE)).otherwise(F.col(IS_DELETE)).desc()]
    if tie_break is not None:
        first = first_per_key(flagged, keys, order + settle(flagged, tie_break)).withColumn(TIED, F.lit(False))
    else:
        first = first_per_key(flagged, keys, order, flag=TIED, alike=[ts, IS_DELETE])
        first = first.withColumn(TIED, F.col(TIED) & ~F.col(IS_DELETE))
    return first.filter(~(F.col(IS_DELETE) & keyless))


def tied_changes(feed: DataFrame, reduced: DataFrame, keys: list[str], ts: str = "ts_ms") -> DataFrame:
    """All upserts of the feed that ``reduced`` has one tied row for."""
    names = [f"_fl_k{i}" for i in range(len(keys))]
    asked = reduced.filter(TIED).select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(ts).alias("_fl_top"))
    upserts = _flagged(feed, ts).filter(~F.col(IS_DELETE))
    return upserts.join(asked, same_group(keys) & (F.col(ts) == F.col("_fl_top")), "left_semi")


def effective_changes(feed: DataFrame, keys: list[str], ts: str = "ts_ms", tie_break=None) -> DataFrame:
    """What a batch does to each key: row columns, time and ``_fl_is_delete``.

    Only changes with the newest time of their key count. A delete in a tie wins, so a key
    has either deletes or upserts; tied upserts all stay, or one row per key with ``tie_break``.
    Deletes without a complete key can match nothing and are left out.
    """
    reduced = reduce_changes(feed, keys, ts, tie_break)
    if tie_break is not None:
        return reduced.drop(TIED)
    return reduced.filter(~F.col(TIED)).drop(TIED).unionByName(tied_changes(feed, reduced, keys, ts))


def without_buried(reduced: DataFrame, tombstones: DataFrame, keys: list[str], ts: str = "ts_ms") -> DataFrame:
    """``reduced`` without the upserts that are no newer than the deletion of their key.

    ``tombstones`` has the keys and ``ts``, once a key. A key deleted at the time of an upsert stays
    deleted, as in one batch. Rows without a complete key are never buried.
    """
    names = [f"_fl_g{i}" for i in range(len(keys))]
    kinds = [reduced.schema[c].dataType for c in _as_named(reduced, keys)]
    graves = tombstones.select(*[F.col(f"`{k}`").cast(t).alias(n) for k, n, t in zip(keys, names, kinds)], F.col(f"`{ts}`").alias("_fl_buried"))
    same = all_of(F.col(f"`{k}`") == F.col(n) for k, n in zip(keys, names))
    late = ~F.col(IS_DELETE) & (F.col(f"`{ts}`") <= F.col("_fl_buried"))
    return reduced.join(graves, same & late, "left_anti")


def bury(reduced: DataFrame, tombstones: DataFrame | None, keys: list[str], keep: int, ts: str = "ts_ms") -> DataFrame:
    """The tombstones after a batch: keys and ``ts`` of the deletions that stand.

    The newest of a key counts; an upsert that was not buried ends it. Those older than ``keep``
    before the newest time of the batch and of all tombstones are forgotten.
    """
    own = [F.col(f"`{k}`") for k in keys]
    events = reduced.filter(none_null(keys)).select(*own, F.col(f"`{ts}`").alias(ts), IS_DELETE)
    if tombstones is not None:
        events = events.unionByName(tombstones.select(*own, F.col(f"`{ts}`").alias(ts), F.lit(True).alias(IS_DELETE)))
    last = events.groupBy(*keys).agg(F.max(F.struct(F.col(ts), F.col(IS_DELETE))).alias("last"))
    newest = events.agg(F.max(ts).alias("_fl_newest"))
    # One row: the newest time.
    kept = last.join(F.broadcast(newest), F.col(f"last.{ts}") >= F.col("_fl_newest") - F.lit(keep), "left_semi")
    return kept.filter(f"last.{IS_DELETE}").select(*own, F.col(f"last.{ts}").alias(ts))


def apply_actions(
    target: DataFrame,
    reduced: DataFrame,
    tied: DataFrame | None,
    keys: list[str],
    ts: str = "ts_ms",
    guard: str | None = None,
    gather_by: Sequence[Column] = (),
    aligned: bool = False,
) -> DataFrame:
    """The rows of a table with the action that a reduced batch takes on each.

    The table is joined once as a whole, to settle its rows, and once by its keys, to find what is
    new; both joins and the hot keys on either side are such as adaptive execution can split, and
    both read one exchange of the batch. ``tied`` holds the tied upserts, which take the place of
    the row that stands for them if their key is new; if it is stored they raise
    MERGE_CARDINALITY_VIOLATION. None vouches that there are none. ``aligned``: the table is
    bucketed by its keys, and is not to be moved.
    """
    by_lower = {c.lower(): c for c in reduced.columns}
    missing = [c for c in target.columns if c.lower() not in by_lower]
    if missing:
        raise ValueError(f"the feed lacks table columns {missing}")
    names = [f"_fl_k{i}" for i in range(len(keys))]
    kinds = [[df.schema[by].dataType for by in _as_named(df, keys)] for df in (target, reduced)]
    # In a struct, which is never null, so that no filter tells the two joins' batches apart. Rows
    # without a complete key spread by a number that no change has.
    packed = kinds[0] == kinds[1] and not aligned

    plain = [F.col(f"`{k}`") for k in keys]

    def key_of(apart: Column) -> list[Column]:
        columns = [F.col(f"`{k}`").alias(n) for k, n in zip(keys, names)]
        return [F.struct(*columns, F.when(any_null(keys), apart).otherwise(0).alias("apart")).alias(_KEY)] if packed else columns

    held = [_KEY] if packed else names
    parts = [F.col(f"{_KEY}.{n}") if packed else F.col(n) for n in names]
    row = F.struct(*[F.col(f"`{by_lower[c.lower()]}`").alias(c) for c in target.columns]).alias(_ROW)
    more = [F.col(f"`{guard}`").alias(_GUARD)] if guard is not None and guard != ts else []
    batch = reduced.select(*key_of(F.lit(-1).cast("long")), row, IS_DELETE, TIED, F.col(f"`{ts}`").alias(_TIME), *more)

    apart, near = None, target
    if not aligned and kinds[0] == kinds[1] and prunes(target, plain, reduced, plain):
        near, apart = split(target, plain, bitmap(reduced, plain))
    stored = near if packed else near.filter(none_null(keys))
    here = [f"_fl_t{i}" for i in range(len(held))]
    hashed = [F.col(f"`{c}`") for c, kind in target.dtypes if "map<" not in kind and "variant" not in kind]
    own = [c.alias(n) for c, n in zip(key_of(F.shiftrightunsigned(F.xxhash64(*hashed), 1) + 1), here)]
    same = all_of(F.col(n) == F.col(h) for n, h in zip(here, held))
    joined = stored.select("*", *own).alias("t").join(batch, same, "left_outer")
    acts = F.col(_TIME).isNotNull()  # a change always has a time
    if guard is not None:
        time = F.col(f"t.`{guard}`")
        acts &= time.isNull() | (F.col(_GUARD if more else _TIME) >= time)
    violation = F.when(acts & F.col(TIED), F.raise_error(F.lit(CARDINALITY_ERROR)).cast("boolean")).otherwise(True)
    action = F.when(acts & F.col(IS_DELETE), DELETED).when(acts, UPDATED).otherwise(KEPT)
    settled = joined.filter(violation).withColumn(ACTION, action)

    def updated(field) -> Column:
        old, new = F.col(f"t.`{field.name}`"), F.col(_ROW).getField(field.name).cast(field.dataType)
        return F.when(F.col(ACTION) == UPDATED, new).otherwise(old).alias(field.name)

    out = settled.select(*[updated(f) for f in target.schema.fields], ACTION)
    if apart is not None:
        out = out.unionByName(apart.withColumn(ACTION, F.lit(KEPT)))
    elif not packed and any(f.nullable for f in target.select(*[f"`{k}`" for k in keys]).schema.fields):
        out = out.unionByName(target.filter(any_null(keys)).withColumn(ACTION, F.lit(KEPT)))

    known = near.filter(none_null(keys)).select(*[c.alias(n) for c, n in zip(key_of(F.lit(0).cast("long")), here)])
    if fits_broadcast(batch):
        # Found without moving the table: the keys that it shares with the batch.
        asked = batch.select(*held).distinct()
        known = known.join(asked, same, "left_semi").distinct()
    fresh = batch.join(known, same, "left_anti")
    kept = ~F.col(IS_DELETE)
    if tied is not None:
        others = tied.select(
            *[F.col(f"`{k}`").alias(f"_fl_o{i}") for i, k in enumerate(keys)], F.col(f"`{ts}`").alias("_fl_ots"), row.alias("_fl_orow")
        )
        on = all_of(p.eqNullSafe(F.col(f"_fl_o{i}")) for i, p in enumerate(parts))
        fresh = fresh.join(others, on & (F.when(F.col(TIED), F.col(_TIME)) == F.col("_fl_ots")), "left_outer")
        kept = F.col("_fl_orow").isNotNull() | kept
        fresh = fresh.filter(kept).select(F.coalesce("_fl_orow", _ROW).alias(_ROW))
    else:
        fresh = fresh.filter(kept)
    new = fresh.select(*[F.col(_ROW).getField(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields], F.lit(INSERTED).alias(ACTION))
    return out.unionByName(gather(new, gather_by))


def _as_named(df: DataFrame, keys: list[str]) -> list[str]:
    """The columns of ``df`` that are ``keys``, whatever their case."""
    by_lower = {c.lower(): c for c in df.columns}
    return [by_lower[k.lower()] for k in keys]


def merge_effective(
    target: DataFrame,
    effective: DataFrame,
    keys: list[str],
    guard: str | None = None,
    unique: bool = False,
    gather_by: Sequence[Column] = (),
) -> MergeBuilder:
    """The one merge that applies ``effective_changes`` to a table.

    With ``guard`` (a time column) a change older than the stored row leaves it alone.
    """
    gone = F.col(f"s.{IS_DELETE}")
    fresh = F.lit(True)
    if guard is not None:
        fresh = F.col(f"t.{guard}").isNull() | (F.col(f"s.{guard}") >= F.col(f"t.{guard}"))
    return (
        merge(
            target,
            effective,
            keys,
            source_alias="s",
            unique_source=unique,
            gather_by=gather_by,
            ambiguous_if=~F.col(f"s.{IS_DELETE}"),
        )
        .when_matched_delete(gone & fresh)
        .when_matched_update_all(~gone & fresh)
        .when_not_matched_insert_all(~gone)
    )


def apply_changes(
    target: DataFrame,
    feed: DataFrame,
    keys: list[str],
    ts: str = "ts_ms",
    tie_break=None,
    guard: str | None = None,
    tombstones: DataFrame | None = None,
) -> DataFrame:
    """The table after a batch: newest change per key, upserts, then deletes, in one merge.

    Several tied upserts on a key the table has raise MERGE_CARDINALITY_VIOLATION; on a
    new key all are inserted. ``tie_break`` keeps one row per key instead. ``tombstones`` (keys
    and ``ts`` of earlier deletions, see ``bury``) keeps late upserts from undoing them.
    """
    reduced = reduce_changes(feed, keys, ts, tie_break)
    if tombstones is not None:
        reduced = without_buried(reduced, tombstones, keys, ts)
    tied = None if tie_break is not None else _flagged(feed, ts).filter(~F.col(IS_DELETE))
    return resolve(apply_actions(target, reduced, tied, keys, ts, guard))


def apply_batch(
    table: LakeTable,
    feed: DataFrame,
    keys: list[str],
    ts: str = "ts_ms",
    tie_break=None,
    guard: str | None = None,
    batch: str | None = None,
    tombstones: int | None = None,
) -> int:
    """Apply a batch to a stored table and commit; creates the table if there is none.

    A sliced table is read and rewritten only where the batch falls.
    ``batch`` labels the commit; ``LakeTable.has_batch`` tells whether a label was committed.
    ``tombstones``: for so many ms deletions are remembered beside the table, and upserts that are
    no newer do not undo them; it needs ``guard``, which does the same for stored rows.
    """
    if tombstones is not None and guard is None:
        raise ValueError("tombstones need a guard column")
    table.recover()
    last = table.version
    version = 0 if last is None else last + 1
    reduced = reduce_changes(feed, keys, ts, tie_break)
    graves = table.tombstones() if tombstones is not None else None
    if graves is not None:
        reduced = without_buried(reduced, graves, keys, ts)
    reduced = table.stage(reduced, version)
    if tombstones is not None:
        table.stage(bury(reduced, graves, keys, tombstones, ts), version, "tombstones")
    tied = None
    if tie_break is None and not reduced.filter(TIED).isEmpty():
        tied = table.stage(tied_changes(feed, reduced, keys, ts), version, "ties")
    touched = table.stage(table.slices_of(reduced), version, "touched") if table.layout.slices else None
    if last is None:
        target = reduced.drop(IS_DELETE, TIED).limit(0)
    else:
        target = table.snapshot(last) if touched is None else table.in_slices(touched)
    actions = apply_actions(
        target, reduced, tied, keys, ts, guard, gather_by=table.layout.file_columns(), aligned=bool(table.layout.buckets)
    )
    return table.commit(actions, "merge", version, batch, touched, keyed=True)


def first_load(feed: DataFrame, keys: list[str], ts: str = "ts_ms") -> DataFrame:
    """Content of a table created from a batch: its newest upserts; deletes do not count."""
    return drop_control(upserts(latest_per_key(as_changes(feed), keys, ts)))
