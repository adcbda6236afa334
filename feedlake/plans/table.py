"""A table kept as numbered Parquet snapshots, or as one Parquet table partitioned by slice.

``<root>/snapshot=<n>/`` holds what commit n wrote. ``<root>/commits/version=<n>/`` is one
row about that commit, and is written last: it makes the commit valid, so a run that dies
half-way leaves nothing visible and the next run writes the same number again. No writer touches
a snapshot that has been committed. One writer per table.

A sliced table has its rows in ``<root>/data``, partitioned by the slice. A commit writes the new
content of the slices that it touches aside, in ``<root>/pending``, announces itself in
``<root>/intents``, and lets Spark overwrite just those partitions. A writer that finds an
announced commit that was not finished finishes it first; until then, and while partitions are
being overwritten, readers may see some slices as they were and some as they will be. Only the
current rows are kept. A slice that was touched has one row that marks it as overwritten, should it
lose all others, and that no reader sees. The first commit writes ``<root>/data`` at once: until it
is recorded there is no table, and the next writer overwrites all of what is there.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, Observation, Row, SparkSession, functions as F
from pyspark.sql.types import BooleanType, LongType, StructType

from feedlake.functions.expressions import as_condition, gather
from feedlake.operators.merge import MergeBuilder, merge
from feedlake.operators.rowchanges import (
    ACTION,
    INSERTED,
    KEPT,
    METRICS,
    delete_actions,
    metric_columns,
    resolve,
    update_actions,
)
from feedlake.sources.layout import SLICE, Layout
from feedlake.sources.storage import newest_folder, repeatable

_ROOT_PROPERTY = "feedlake.root"
#: False in the row that marks a slice without rows.
HELD = "fl_held"
#: The action of such a row, which no metric counts.
_MARKS = "marks"
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@dataclass(frozen=True)
class LakeTable:
    spark: SparkSession
    root: str
    layout: Layout = Layout()
    name_alias: str = "t"
    registered: str | None = None

    # -- finding tables --------------------------------------------------------------

    @classmethod
    def at(cls, spark: SparkSession, root: str, layout: Layout = Layout()) -> LakeTable:
        """Handle for a table that may not exist yet. One that does has a layout for good:
        it is taken over, and asking for another one is an error."""
        table = cls(spark, root.rstrip("/"), layout)
        version = table.version
        if version is None:
            return table
        stored = Layout.from_json(table._commit(version)["layout"])
        if layout not in (Layout(), stored):
            raise ValueError(f"{root} is laid out as {stored}, not as {layout}")
        return replace(table, layout=stored)

    @classmethod
    def for_path(cls, spark: SparkSession, root: str) -> LakeTable:
        table = cls.at(spark, root)
        if table.version is None:
            raise ValueError(f"no table at {root}")
        return table

    @classmethod
    def for_name(cls, spark: SparkSession, name: str) -> LakeTable:
        """Handle for a table made known with ``register``."""
        rows = spark.sql(f"show tblproperties {name}").filter(F.col("key") == _ROOT_PROPERTY).collect()
        if not rows:
            raise ValueError(f"{name} is not a registered table")
        return replace(cls.for_path(spark, rows[0]["value"]), registered=name)

    @classmethod
    def is_table(cls, spark: SparkSession, root: str) -> bool:
        return cls.at(spark, root).version is not None

    @classmethod
    def convert(
        cls,
        spark: SparkSession,
        parquet_path: str,
        root: str,
        partition_schema=None,
        layout: Layout = Layout(),
    ) -> LakeTable:
        """Copy an existing Parquet table to snapshot 0. ``partition_schema`` (DDL text or
        StructType) gives the types of columns kept in folder names."""
        table = cls.at(spark, root, layout)
        if table.version is not None:
            raise ValueError(f"{root} already holds a table")
        table.create(cls._existing(spark, parquet_path, partition_schema), "convert")
        return table

    @classmethod
    def adopt(cls, spark: SparkSession, parquet_path: str, root: str, partition_schema=None) -> LakeTable:
        """Make an existing Parquet table snapshot 0 where it lies: no file is written but the
        commit, and none of the table is changed later, as further snapshots go to ``root``.
        Only an unsliced, unbucketed table can hold files that others laid out."""
        table = cls(spark, root.rstrip("/"))
        if table.version is not None:
            raise ValueError(f"{root} already holds a table")
        content = cls._existing(spark, parquet_path, partition_schema)
        record = table._record("adopt", None, {"rows_inserted": content.count()}, content.schema, location=parquet_path.rstrip("/"))
        record.write.mode("overwrite").parquet(f"{table.root}/commits/version=0")
        return table

    @staticmethod
    def _existing(spark: SparkSession, parquet_path: str, partition_schema=None) -> DataFrame:
        reader = spark.read
        if partition_schema is not None:
            if isinstance(partition_schema, str):
                partition_schema = StructType.fromDDL(partition_schema)
            # Only the files' own columns come from their footers.
            kept = spark.read.parquet(parquet_path).schema
            typed = {f.name: f for f in partition_schema.fields}
            unknown = set(typed) - set(kept.fieldNames())
            if unknown:
                raise ValueError(f"no partition columns {sorted(unknown)} in {parquet_path}")
            reader = reader.schema(StructType([typed.get(f.name, f) for f in kept.fields]))
        return reader.parquet(parquet_path)

    def register(self, name: str) -> LakeTable:
        """Point the catalog view ``name`` at the current snapshot."""
        version = self._current()
        commit = self._commit(version)
        held = ""
        if place := commit.asDict().get("location"):
            relation = self._adopted_table(name, commit, place)
        elif not self.layout.slices:
            relation = f"parquet.`{self.root}/snapshot={version}`"
        else:
            relation, held = self._slice_table(name, commit), f" where {HELD}"
        columns = ", ".join(f"`{c}`" for c in _schema(commit).names)
        self.spark.sql(
            f"create or replace view {name} tblproperties ('{_ROOT_PROPERTY}' = '{self.root}') "
            f"as select {columns} from {relation}{held}"
        )
        return replace(self, registered=name)

    def _adopted_table(self, name: str, commit: Row, place: str) -> str:
        """A catalog table over files where they lie, partition by partition."""
        schema, relation = _schema(commit), f"{name}__adopted"
        one = self.spark.read.schema(schema).parquet(place).select(F.input_file_name()).first()
        stored = {c.lower() for c in self.spark.read.parquet(one[0]).columns} if one else {c.lower() for c in schema.names}
        folders = [f.name for f in schema.fields if f.name.lower() not in stored]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by = f" partitioned by ({', '.join(f'`{c}`' for c in folders)})" if folders else ""
        self.spark.sql(f"drop table if exists {relation}")  # an external table: its files stay
        self.spark.sql(f"create table {relation} ({columns}) using parquet{by} location '{place}'")
        if folders:
            self.spark.sql(f"msck repair table {relation}")
        return relation

    def _slice_table(self, name: str, commit: Row) -> str:
        """The catalog table over the partitions, made known to it by Spark."""
        sql = self.spark.sql
        relation = f"{name}__data"
        wanted = [(f.name, f.dataType.simpleString()) for f in _schema(commit).fields] + [(HELD, "boolean"), (SLICE, "bigint")]
        if self.spark.catalog.tableExists(relation):
            if self.spark.table(relation).dtypes != wanted:
                sql(f"drop table {relation}")  # an external table: its files stay
        columns = ", ".join(f"`{c}` {kind}" for c, kind in wanted)
        sql(f"create table if not exists {relation} ({columns}) using parquet partitioned by ({SLICE}) location '{self.root}/data'")
        sql(f"msck repair table {relation} sync partitions")
        return relation

    def alias(self, name: str) -> LakeTable:
        return replace(self, name_alias=name)

    # -- reading ---------------------------------------------------------------------

    @property
    def version(self) -> int | None:
        """Number of the current snapshot, None before the first commit."""
        return newest_folder(self.spark, f"{self.root}/commits", "version")

    def _current(self) -> int:
        version = self.version
        if version is None:
            raise ValueError(f"no table at {self.root}")
        return version

    def _commit(self, version: int) -> Row:
        """The one row about a commit."""
        return self.spark.read.parquet(f"{self.root}/commits/version={version}").first()

    def _bucketed_name(self, version: int) -> str:
        # The whole root tells tables apart: their last folders may be alike.
        mark = hashlib.sha256(self.root.encode()).hexdigest()[:16]
        return f"{self.layout.database}.{self.root.rsplit('/', 1)[-1].replace('.', '_')}_{mark}__{version}"

    def snapshot(self, version: int) -> DataFrame:
        """The table as of a commit; a sliced table has its current rows only."""
        if self.layout.buckets:
            name = self._bucketed_name(version)
            if self.spark.catalog.tableExists(name):
                return self.spark.table(name)
        commit = self._commit(version)
        schema = _schema(commit)
        if not self.layout.slices:
            place = commit.asDict().get("location") or f"{self.root}/snapshot={version}"
            return self.spark.read.schema(schema).parquet(place)
        if version != self.version:
            raise ValueError(f"{self.root}: a sliced table keeps its current rows only")
        return self._slices(schema).select(*[F.col(f"`{c}`") for c in schema.names])

    def _slices(self, schema: StructType) -> DataFrame:
        """The rows with the slice that each lies in, a partition column."""
        stored = StructType(schema.fields).add(HELD, BooleanType()).add(SLICE, LongType())
        return self._partitions(stored, f"{self.root}/data").where(HELD)

    def _partitions(self, stored: StructType, place: str) -> DataFrame:
        """The partitioned table at ``place``, its folders listed by a few tasks instead of one each."""
        before = self.spark.conf.get(_LISTING)
        self.spark.conf.set(_LISTING, min(int(before), 4 * self.spark.sparkContext.defaultParallelism))
        try:
            return self.spark.read.schema(stored).parquet(place)
        finally:
            self.spark.conf.set(_LISTING, before)

    def in_slices(self, touched: DataFrame) -> DataFrame:
        """The rows of the slices listed in ``touched``: a join on the partition column, by which
        Spark prunes the partitions that it reads."""
        schema = _schema(self._commit(self._current()))
        # Spark prunes by a side that it takes to be a selection, which a comparison tells it.
        listed = touched.where(F.col(SLICE) > F.lit(-(1 << 63)))
        rows = self._slices(schema).join(listed, SLICE, "left_semi")
        return rows.select(*[F.col(f"`{c}`") for c in schema.names])

    def slices_of(self, rows: DataFrame) -> DataFrame:
        """The slices that rows with the table's keys fall in, each once."""
        schema = _schema(self._commit(self._current())) if self.version is not None else rows.schema
        kinds = {f.name.lower(): f.dataType for f in schema.fields}
        keys = [F.col(f"`{k}`").cast(kinds[k.lower()]).alias(k) for k in self.layout.keys]
        return rows.select(*keys).select(self.layout.slice_of().alias(SLICE)).distinct()

    def to_df(self) -> DataFrame:
        return self.snapshot(self._current())

    def changed_keys(self, since: int, keys: list[str]) -> DataFrame | None:
        """The keys that batches have changed after the commit ``since``, from what they staged;
        None if another commit came in between, whose keys are not known."""
        newer = self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/commits").filter(F.col("version") > since)
        if "keyed" not in newer.columns:
            return None
        versions, known = newer.agg(F.array_sort(F.collect_list("version")), F.every(F.coalesce("keyed", F.lit(False)))).first()
        if not versions or not known:
            return None
        staged = (self.spark.read.parquet(f"{self.root}/changes/version={v}") for v in versions)
        return reduce(DataFrame.union, (df.select(*[F.col(f"`{k}`") for k in keys]) for df in staged))

    def tombstones(self) -> DataFrame | None:
        """Keys that batches have deleted, with the time of the deletion, as of the current commit."""
        current = self.version
        version = None if current is None else newest_folder(self.spark, f"{self.root}/tombstones", "version", current)
        return None if version is None else self.spark.read.parquet(f"{self.root}/tombstones/version={version}")

    def history(self, limit: int | None = None) -> DataFrame:
        """Commits, newest first."""
        self._current()
        commits = self.spark.read.option("mergeSchema", True).parquet(f"{self.root}/commits")
        commits = commits.drop("replaces", "keyed", "schema", "layout", "location").orderBy(F.desc("version"))
        return commits if limit is None else commits.limit(limit)

    def show_history(self, rows: int = 20) -> None:
        self.history(rows).show(rows, truncate=False)

    # -- changing --------------------------------------------------------------------

    def merge(self, source: DataFrame, condition, source_alias: str | None = None) -> TableMerge:
        by_keys = isinstance(condition, (list, tuple)) and self.layout.buckets
        gather_by = self.layout.file_columns() if by_keys else ()
        builder = merge(self.to_df(), source, condition, self.name_alias, source_alias, gather_by=gather_by)
        return TableMerge(self, builder)

    def create(self, content: DataFrame, operation: str = "create") -> int:
        """Make ``content`` the next snapshot as it is."""
        actions = gather(content, self.layout.file_columns()).withColumn(ACTION, F.lit(INSERTED))
        return self.commit(actions, operation, replaces=True, aligned=True)

    def delete(self, condition=None) -> int:
        self.recover()
        return self.commit(delete_actions(self.to_df(), as_condition(condition)), "delete", aligned=True)

    def update(self, condition=None, set=None) -> int:
        self.recover()
        actions = update_actions(self.to_df(), set, condition)
        moves = self.moves_keys(set)
        return self.commit(actions, "update", replaces=moves, aligned=not moves)

    def moves_keys(self, set: dict) -> bool:
        """Whether an assignment may carry rows from one slice to another."""
        assigned = {c.lower() for c in set}
        return bool(self.layout.slices) and any(k.lower() in assigned for k in self.layout.keys)

    def commit(
        self,
        actions: DataFrame,
        operation: str,
        version: int | None = None,
        batch: str | None = None,
        touched: DataFrame | None = None,
        replaces: bool = False,
        aligned: bool = False,
        keyed: bool = False,
    ) -> int:
        """Write the outcome of ``actions`` as the next snapshot and record it.

        The counts are observed while the snapshot is written, in the same job.
        In a sliced table only the slices ``touched`` are written and counted, of which ``actions``
        then has all rows; without it they are those with a change, found first. If ``actions``
        ``replaces`` the table, as it must if it changes the keys of stored rows, all are written.
        Its rows are brought together by slice first, unless they are ``aligned``: lie as they
        were stored. ``keyed``: the staged batch of this version has the keys of all changes.
        """
        current = self.version
        if version is None:
            version = 0 if current is None else current + 1
        begins = bool(self.layout.slices) and current is None
        schema = actions.drop(ACTION).schema
        if self.layout.slices:
            reserved = {HELD, SLICE} & {n.lower() for n in schema.names}
            if reserved:
                raise ValueError(f"a sliced table cannot have columns named {sorted(reserved)}")
            actions = actions.withColumn(SLICE, self.layout.slice_of())
            if not replaces and touched is None:
                changed = actions.filter(F.col(ACTION) != KEPT).select(SLICE).distinct()
                touched = self.stage(changed, version, "touched")
                actions = actions.join(touched, SLICE, "left_semi").select(*actions.columns)
            actions = actions.withColumn(HELD, F.lit(True))
            if touched is not None and not begins:
                # The marks go with the rows of their slices, into the same files.
                marks = touched.select(SLICE).withColumns({HELD: F.lit(False), ACTION: F.lit(_MARKS)})
                actions = actions.unionByName(marks, allowMissingColumns=True)
            if not aligned:
                actions = gather(actions, [F.col(SLICE)])
        seen = Observation()
        self._write(resolve(actions.observe(seen, *metric_columns())), version, begins)
        record = self._record(operation, batch, seen.get, schema, replaces, keyed)
        if self.layout.slices and not begins:
            record.write.mode("overwrite").parquet(f"{self.root}/intents/version={version}")
            self._overwrite(version)
        else:
            record.write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")
        if self.registered:
            self.register(self.registered)
        return version

    def _record(
        self, operation: str, batch: str | None, counts: dict, schema: StructType,
        replaces: bool = False, keyed: bool = False, location: str | None = None,
    ) -> DataFrame:
        """The one row about a commit."""
        return self.spark.range(1, numPartitions=1).select(
            F.lit(operation).alias("operation"),
            F.lit(batch).cast("string").alias("batch"),
            *[F.lit(int(counts.get(m) or 0)).cast("long").alias(m) for m in METRICS],
            F.current_timestamp().alias("committed_at"),
            F.lit(schema.json()).alias("schema"),
            F.lit(self.layout.to_json()).alias("layout"),
            F.lit(replaces).alias("replaces"),
            F.lit(keyed).alias("keyed"),
            F.lit(location).cast("string").alias("location"),
        )

    def _write(self, content: DataFrame, version: int, begins: bool) -> None:
        path = f"{self.root}/snapshot={version}"
        if self.layout.buckets:
            writer = content.write.mode("overwrite").format("parquet").bucketBy(self.layout.buckets, *self.layout.keys)
            writer.sortBy(*self.layout.keys).option("path", path).saveAsTable(self._bucketed_name(version))
        elif self.layout.slices:
            place = f"{self.root}/data" if begins else f"{self.root}/pending/version={version}"
            content.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(SLICE).parquet(place)
        else:
            content.write.mode("overwrite").parquet(path)

    def _overwrite(self, version: int) -> None:
        """Finish an announced commit; doing so again changes nothing."""
        record = self.spark.read.parquet(f"{self.root}/intents/version={version}")
        row = record.first()
        stored = StructType(_schema(row).fields).add(HELD, BooleanType()).add(SLICE, LongType())
        content = self._partitions(stored, f"{self.root}/pending/version={version}")
        mode = "static" if row["replaces"] else "dynamic"
        content.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(SLICE).parquet(f"{self.root}/data")
        record.write.mode("overwrite").parquet(f"{self.root}/commits/version={version}")

    def recover(self) -> None:
        """Finish the commit that a writer announced but did not live to finish."""
        if not self.layout.slices:
            return
        announced = newest_folder(self.spark, f"{self.root}/intents", "version")
        current = self.version
        if announced is not None and (current is None or announced > current):
            self._overwrite(announced)

    def stage(self, changes: DataFrame, version: int, kind: str = "changes") -> DataFrame:
        """Write a reduced batch beside the table and read it back.

        The feed is then read once, a lost executor costs no replay of it, and Spark knows
        the batch's real size when it plans the merge.
        """
        path = f"{self.root}/{kind}/version={version}"
        changes.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(changes.schema).parquet(path)

    def has_batch(self, label: str) -> bool:
        """Whether a commit bears this batch label."""
        self.recover()
        if self.version is None:
            return False
        commits = self.spark.read.parquet(f"{self.root}/commits")
        return not commits.filter(F.col("batch") == label).isEmpty()


def _schema(commit: Row) -> StructType:
    return StructType.fromJson(json.loads(commit["schema"]))


@dataclass(frozen=True)
class TableMerge:
    """A merge builder bound to a table: same clauses, and ``execute`` commits."""

    table: LakeTable
    builder: MergeBuilder

    def when_matched_update(self, condition=None, set=None) -> TableMerge:
        return replace(self, builder=self.builder.when_matched_update(condition, set))

    def when_matched_update_all(self, condition=None) -> TableMerge:
        return replace(self, builder=self.builder.when_matched_update_all(condition))

    def when_matched_delete(self, condition=None) -> TableMerge:
        return replace(self, builder=self.builder.when_matched_delete(condition))

    def when_not_matched_insert(self, condition=None, values=None) -> TableMerge:
        return replace(self, builder=self.builder.when_not_matched_insert(condition, values))

    def when_not_matched_insert_all(self, condition=None) -> TableMerge:
        return replace(self, builder=self.builder.when_not_matched_insert_all(condition))

    def to_df(self) -> DataFrame:
        return self.builder.to_df()

    def execute(self) -> int:
        """Commit the merge; returns the new version.

        The source is read once and kept in the shared folder for the commit: its clauses and
        the two passes over a sliced table must all see the same rows, also of a source that
        gives others each time it is read.
        """
        table, source = self.table, repeatable(self.builder.source, self.table.root)
        table.recover()
        builder, touched, moves = replace(self.builder, source=source), None, self._moves_keys()
        if table.layout.slices:
            builder = replace(builder, target=table.to_df())
            if not moves and self._stays_in_slices():
                # What the source does happens in the slices of its own rows.
                version = table.version + 1
                touched = table.stage(table.slices_of(source), version, "touched")
                builder = replace(builder, target=table.in_slices(touched))
        return table.commit(builder.actions(), "merge", touched=touched, replaces=moves)

    def _stays_in_slices(self) -> bool:
        """Whether all rows that change have the keys of a source row, by name."""
        keys = {k.lower() for k in self.table.layout.keys}
        inserted = self.builder.not_matched
        named = keys <= self.builder.match.named and keys <= {c.lower() for c in self.builder.source.columns}
        return named and (inserted is None or inserted.values is None)

    def _moves_keys(self) -> bool:
        layout = self.table.layout
        for values in self.builder.updates():
            if values is not None:
                if self.table.moves_keys(values):
                    return True
            elif layout.slices and not {k.lower() for k in layout.keys} <= self.builder.match.named:
                return True  # all columns are taken from a source row with maybe other keys
        return False
