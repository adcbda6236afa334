"""Conditional update, delete and insert of a table from a source DataFrame.

A merge is planned as up to two joins, each only if a clause needs it:

* rows of the table: table LEFT JOIN source (one source row per key), which settles
  keep, update and delete;
* rows to insert: source LEFT ANTI the keys the table already has, which, for a source that
  Spark may broadcast, are first cut down to keys the source touches.

A table much larger than a source that is too large to be broadcast is first cut down to the
rows that may match (see ``pruning``); the others go past the joins.

A predicate is taken apart (see ``predicates``): one that only says which keys are equal, by
whatever names, is a merge by keys; one that says more is checked on pairs joined by its
equalities, or by bins of a range.

Every join streams its large side, so Spark may broadcast a small source (by its own
size threshold) or, for a table bucketed by the keys, read it without an exchange. Hot
keys never meet in one task: source keys are reduced map-side before they move, rows
with a null key bypass the joins, and the remaining joins are of kinds adaptive
execution can split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from feedlake.functions.expressions import (
    all_of,
    as_assignments,
    as_condition,
    fits_broadcast,
    gather,
    is_true,
    none_null,
)
from feedlake.operators.latest import first_per_key
from feedlake.operators.predicates import BIN, Match, analyse, with_bins
from feedlake.operators.pruning import bitmap, prunes, split
from feedlake.operators.rowchanges import (
    ACTION,
    DELETED,
    INSERTED,
    KEPT,
    UPDATED,
    change_metrics,
    resolve,
    target_columns,
)

#: Spark lets a query raise texts only, not its own conditions by name, so this has the state of a
#: text raised by a user (P0001).
CARDINALITY_ERROR = "MERGE_CARDINALITY_VIOLATION: several source rows match one row of the table"

_SRC = "_fl_src"
_HIT = "_fl_hit"
_DUP = "_fl_dup"
_ROW = "_fl_row"
_KEY = "_fl_key"


@dataclass(frozen=True)
class _Clause:
    action: str
    condition: Column | None
    values: dict[str, Column] | None  # None: every column from its namesake


@dataclass(frozen=True)
class MergeBuilder:
    """Ordered clauses of one merge. Every method returns a new builder; nothing runs."""

    target: DataFrame
    source: DataFrame
    match: Match
    condition: Column | None  # None: the keys of ``match`` decide
    target_alias: str
    unique_source: bool = False
    gather_by: tuple[Column, ...] = ()
    ambiguous_if: Column | None = None
    matched: tuple[_Clause, ...] = ()
    not_matched: _Clause | None = None

    # -- clauses -------------------------------------------------------------------

    def when_matched_update(self, condition=None, set=None) -> MergeBuilder:
        values = target_columns(self.target.schema, as_assignments(set), "set")
        return self._with_matched(_Clause(UPDATED, as_condition(condition), values))

    def when_matched_update_all(self, condition=None) -> MergeBuilder:
        self._require_all_columns()
        return self._with_matched(_Clause(UPDATED, as_condition(condition), None))

    def when_matched_delete(self, condition=None) -> MergeBuilder:
        return self._with_matched(_Clause(DELETED, as_condition(condition), None))

    def when_not_matched_insert(self, condition=None, values=None) -> MergeBuilder:
        assigned = target_columns(self.target.schema, as_assignments(values, "values"), "values")
        return self._with_insert(_Clause(INSERTED, as_condition(condition), assigned))

    def when_not_matched_insert_all(self, condition=None) -> MergeBuilder:
        self._require_all_columns()
        return self._with_insert(_Clause(INSERTED, as_condition(condition), None))

    def _with_matched(self, clause: _Clause) -> MergeBuilder:
        if any(c.action == clause.action for c in self.matched):
            raise ValueError(f"a merge takes one matched clause that makes rows {clause.action}")
        if self.matched and self.matched[0].condition is None:
            raise ValueError("the first of two matched clauses needs a condition")
        return replace(self, matched=self.matched + (clause,))

    def _with_insert(self, clause: _Clause) -> MergeBuilder:
        if self.not_matched is not None:
            raise ValueError("a merge takes one not-matched clause")
        return replace(self, not_matched=clause)

    def _require_all_columns(self) -> None:
        have = {c.lower() for c in self.source.columns}
        missing = [c for c in self.target.columns if c.lower() not in have]
        if missing:
            raise ValueError(f"the source lacks table columns {missing}")

    def updates(self) -> list[dict[str, Column] | None]:
        """Assignments of the update clause, if there is one; None stands for all columns."""
        return [c.values for c in self.matched if c.action == UPDATED]

    # -- results -------------------------------------------------------------------

    def actions(self) -> DataFrame:
        """All rows, deleted ones included, with the action taken on each."""
        if not self.matched and self.not_matched is None:
            raise ValueError("a merge needs at least one clause")
        table = self._table_by_condition() if self.condition is not None else self._table_by_key()
        if self.not_matched is None:
            return table
        return table.unionByName(self._inserted())

    def to_df(self) -> DataFrame:
        """The table after the merge."""
        return resolve(self.actions())

    def metrics(self) -> DataFrame:
        """One row of counts: inserted, updated, deleted, kept."""
        return change_metrics(self.actions())

    # -- rows of the table -----------------------------------------------------------

    @property
    def _only_plain_delete(self) -> bool:
        return len(self.matched) == 1 and self.matched[0].action == DELETED and self.matched[0].condition is None

    def _kept(self, df: DataFrame) -> DataFrame:
        return df.select(*[F.col(f"`{c}`") for c in self.target.columns], F.lit(KEPT).alias(ACTION))

    def _keyed_source(self, source: DataFrame) -> tuple[DataFrame, list[str]]:
        names = [f"_fl_k{i}" for i in range(len(self.match.source_keys))]
        return source.withColumns(dict(zip(names, self.match.source_keys, strict=True))), names

    def _table_by_key(self) -> DataFrame:
        if not self.matched:
            return self._kept(self.target)
        source, names = self._keyed_source(self.source)
        source = source.filter(none_null(names))
        if self._only_plain_delete:
            reduced = distinct_keys(source, names, names).withColumn(_HIT, F.lit(True))
        else:
            if self.unique_source:
                reduced = source.withColumn(_DUP, F.lit(False))
            else:
                reduced = first_per_key(source, names, [F.lit(1).asc()], flag=_DUP)
            reduced = reduced.withColumns(self._source_columns())
        target, keys = self._target(self.target), self.match.target_keys
        complete = all_of(k.isNotNull() for k in keys)
        on = all_of(k == F.col(n) for k, n in zip(keys, names, strict=True))
        apart = None
        if prunes(target, keys, source, [F.col(n) for n in names]):
            some, apart = split(target, keys, bitmap(source, [F.col(n) for n in names]))
            target = self._target(some)
        joined = target.filter(complete).join(reduced, on, "left_outer")
        if not self._only_plain_delete and not self.unique_source:
            violation = F.col(_HIT).isNotNull() & F.col(_DUP) & is_true(self.ambiguous_if)
            if self.ambiguous_if is not None:
                # The rows of such a key are alike, so what fires for one fires for all.
                fires = [is_true(c.condition) for c in self.matched]
                violation &= reduce(or_, fires)
            joined = joined.filter(self._no_error(violation))
        decided = self._apply_matched(joined, F.col(_HIT).isNotNull())
        if apart is not None:
            return decided.unionByName(self._kept(apart))
        if not any(f.nullable for f in target.select(*keys).schema.fields):
            return decided
        return decided.unionByName(self._kept(target.filter(~complete)))

    def _sides(self, target: DataFrame, source: DataFrame) -> tuple[DataFrame, DataFrame, Column]:
        """Both sides and a condition that holds for the pairs that match, each once."""
        target = self._target(target)
        if self.match.band is None:
            return target, source, self.condition
        target, source = with_bins(target, source, self.match.band)
        source = source.withColumnRenamed(BIN, f"{BIN}_s")
        return target, source, (F.col(BIN) == F.col(f"{BIN}_s")) & self.condition

    def _table_by_condition(self) -> DataFrame:
        if not self.matched:
            return self._kept(self.target)
        numbered = self.target.withColumn(_ROW, F.monotonically_increasing_id())
        target, source, condition = self._sides(numbered, self.source.withColumns(self._source_columns()))
        untouched = self._kept(target.join(source, condition, "left_anti"))
        if self._only_plain_delete:
            gone = target.join(source, condition, "left_semi")
            return untouched.unionByName(
                gone.select(*[F.col(f"`{c}`") for c in self.target.columns], F.lit(DELETED).alias(ACTION))
            )
        pairs = target.join(source, condition, "inner")
        pairs = first_per_key(pairs, [_ROW], [F.lit(1).asc()], flag=_DUP).filter(self._no_error(F.col(_DUP)))
        return untouched.unionByName(self._apply_matched(pairs, F.lit(True)))

    def _target(self, df: DataFrame) -> DataFrame:
        return df.alias(self.target_alias)

    def _source_columns(self) -> dict[str, Column]:
        """A presence flag and, for update-all, the source row under a name of its own."""
        columns = {_HIT: F.lit(True)}
        if any(c.action == UPDATED and c.values is None for c in self.matched):
            by_lower = {c.lower(): c for c in self.source.columns}
            columns[_SRC] = F.struct(
                *[F.col(f"`{by_lower[t.lower()]}`").alias(t) for t in self.target.columns]
            )
        return columns

    @staticmethod
    def _no_error(violation: Column) -> Column:
        # Sits in a filter, so column pruning cannot drop the check.
        return F.when(violation, F.raise_error(F.lit(CARDINALITY_ERROR)).cast("boolean")).otherwise(True)

    def _apply_matched(self, joined: DataFrame, hit: Column) -> DataFrame:
        action = None
        for clause in self.matched:
            fires = hit & is_true(clause.condition)
            action = F.when(fires, clause.action) if action is None else action.when(fires, clause.action)
        decided = joined.withColumn(ACTION, action.otherwise(KEPT))
        update = next((c for c in self.matched if c.action == UPDATED), None)
        columns = []
        for field in self.target.schema.fields:
            old = F.col(f"{self.target_alias}.`{field.name}`")
            if update is None or (update.values is not None and field.name not in update.values):
                columns.append(old.alias(field.name))
                continue
            new = F.col(_SRC).getField(field.name) if update.values is None else update.values[field.name]
            columns.append(
                F.when(F.col(ACTION) == UPDATED, new.cast(field.dataType)).otherwise(old).alias(field.name)
            )
        return decided.select(*columns, ACTION)

    # -- rows to insert --------------------------------------------------------------

    def _inserted(self) -> DataFrame:
        clause = self.not_matched
        candidates = self.source.filter(is_true(clause.condition)) if clause.condition is not None else self.source
        new = self._unmatched_by_condition(candidates) if self.condition is not None else self._unmatched_by_key(candidates)
        by_lower = {c.lower(): c for c in self.source.columns}
        columns = []
        for field in self.target.schema.fields:
            if clause.values is None:
                value = F.col(f"`{by_lower[field.name.lower()]}`")
            else:
                value = clause.values.get(field.name, F.lit(None))
            columns.append(value.cast(field.dataType).alias(field.name))
        inserted = new.select(*columns, F.lit(INSERTED).alias(ACTION))
        return gather(inserted, self.gather_by)

    def _unmatched_by_condition(self, candidates: DataFrame) -> DataFrame:
        target, source, condition = self._sides(self.target, candidates)
        if self.match.band is not None:
            # A source row stands in several bins: what matches in one is told by what it compares.
            found = source.join(target, condition, "left_semi")
            found = found.select(*[F.col(f"`{c}`").alias(f"_fl_r{i}") for i, c in enumerate(self.match.reads)]).distinct()
            same = all_of(F.col(f"`{c}`").eqNullSafe(F.col(f"_fl_r{i}")) for i, c in enumerate(self.match.reads))
            return candidates.join(found, same, "left_anti")
        if fits_broadcast(candidates):
            target = target.join(source, condition, "left_semi")
        return source.join(target, condition, "left_anti")

    def _unmatched_by_key(self, candidates: DataFrame) -> DataFrame:
        candidates, keys = self._keyed_source(candidates)
        names = [f"_fl_t{i}" for i in range(len(keys))]
        own = self.match.target_keys
        stored, asking = self._target(self.target), [F.col(k) for k in keys]
        if prunes(stored, own, candidates, asking):
            stored = self._target(split(stored, own, bitmap(candidates, asking))[0])
        stored = stored.filter(all_of(k.isNotNull() for k in own))
        stored = stored.select(*[k.alias(n) for k, n in zip(own, names, strict=True)])
        if not fits_broadcast(candidates):
            # Source rows with a null key are equal to nothing, and stay.
            return candidates.join(stored, all_of(F.col(k) == F.col(n) for k, n in zip(keys, names, strict=True)), "left_anti")
        # Keys the table and the source share: never more than the source has, and found
        # without moving the table.
        asked = [f"_fl_w{i}" for i in range(len(keys))]
        wanted = distinct_keys(candidates.filter(none_null(keys)), keys, asked)
        touched = stored.join(wanted, all_of(F.col(n) == F.col(w) for n, w in zip(names, asked, strict=True)), "left_semi").distinct()
        # Compared as one struct: both sides get an exchange, so a skewed source can be split,
        # and keys with a null, which ``touched`` never holds, stay unmatched.
        kinds = [f.dataType for f in candidates.select(*keys).schema.fields]
        same = F.struct(*keys) == F.struct(*[F.col(n).cast(t).alias(k) for k, n, t in zip(keys, names, kinds, strict=True)])
        return candidates.join(touched, same, "left_anti")


def distinct_keys(df: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """Each key once, under ``names``; duplicates are dropped map-side before they move."""
    packed = df.select(F.struct(*[F.col(k).alias(n) for k, n in zip(keys, names)]).alias(_KEY)).distinct()
    return packed.select(f"{_KEY}.*")


def merge(
    target: DataFrame,
    source: DataFrame,
    on,
    target_alias: str = "t",
    source_alias: str | None = None,
    unique_source: bool = False,
    gather_by: Sequence[Column] = (),
    ambiguous_if: Column | None = None,
    nested_loop: bool = False,
) -> MergeBuilder:
    """Start a merge of ``source`` into ``target``.

    ``on`` is a list of key columns common to both sides (null keys never match), or a
    predicate as SQL text or Column over ``<target_alias>.<column>`` and the source's
    alias (``source_alias``, or the one given by ``source.alias(...)``). A predicate that says
    only which expressions are equal is a merge by keys, too, and its source is reduced per key
    before any row moves. One with neither an equality nor a range between the two sides can only
    be tried on every pair of rows; that is an error unless asked for by ``nested_loop``.
    ``unique_source`` vouches
    that no key repeats in the source, and skips that check. ``gather_by`` brings inserted
    rows together by these expressions, for a write that makes files by them; rows of the
    table stay where they are. ``ambiguous_if`` limits the check for repeated keys to source
    rows where it is true; the caller vouches that the other rows of a key are alike in what
    the clauses do with them.
    """
    for name, side in (("target", target), ("source", source)):
        if side is None:
            raise ValueError(f"{name}: a DataFrame is required")
        if not isinstance(side, DataFrame):
            raise TypeError(f"{name}: expected a DataFrame, got {type(side).__name__}")
    if on is None:
        raise ValueError("on: key columns or a condition is required")
    if source_alias is not None:
        source = source.alias(source_alias)
    if isinstance(on, (list, tuple)):
        if not on or not all(isinstance(k, str) for k in on):
            raise TypeError("on: key columns must be a non-empty list of str")
        condition = None
        match = Match(
            tuple(F.col(f"{target_alias}.`{k}`") for k in on),
            tuple(F.col(f"`{k}`") for k in on),
            exact=True,
            band=None,
            named=frozenset(k.lower() for k in on),
            reads=(),
        )
    else:
        condition = as_condition(on, "on")
        match = analyse(target.alias(target_alias), source, condition)
        if not match.joins and not nested_loop:
            raise ValueError(
                "on: the condition has no equality and no range between the table and the source; "
                "nested_loop=True tries it on every pair of rows"
            )
        if match.exact:
            condition = None
    return MergeBuilder(target, source, match, condition, target_alias, unique_source, tuple(gather_by), ambiguous_if)
