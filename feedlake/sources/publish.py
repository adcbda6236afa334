"""Curated catalog tables."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlake.functions.expressions import gather

BUCKET = "bucket"


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """A partition column of bounded cardinality from the keys."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def publish(
    df: DataFrame,
    table: str,
    partition_by: list[str] | None = None,
    keys: list[str] | None = None,
    buckets: int | None = None,
) -> str:
    """Create ``table`` from ``df``, or replace its content. Returns "created" or "replaced".

    ``partition_by`` partitions by columns as they are; ``keys`` with ``buckets``
    partitions by a hash bucket of the keys, one folder per bucket rather than per key.
    Columns go by name: partition columns sit last in a catalog table, so a positional
    insert would shift them. A replaced table keeps its own partitioning.
    """
    spark = df.sparkSession
    replace = spark.catalog.tableExists(table)
    partitions = list(partition_by or [])
    if replace:
        partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    elif keys and buckets:
        partitions.append(BUCKET)
    hashed = _bucket_count(table, spark) is not None if replace else bool(keys and buckets)
    if hashed and BUCKET in {c.lower() for c in df.columns}:
        raise ValueError(f"{table}: {BUCKET} is the name of the hash bucket, and cannot be a column of the rows")
    if BUCKET in partitions and BUCKET not in df.columns:
        if not keys:
            raise ValueError(f"{table} is partitioned by {BUCKET}: keys are required")
        count = _bucket_count(table, spark) if replace else buckets
        if count is None:
            raise ValueError(f"{table} records no bucket count")
        df = with_bucket(df, keys, count)
    if partitions:
        df = gather(df, [F.col(p) for p in partitions])
    if replace:
        columns = spark.table(table).columns
        _require_same_columns(df, columns, table)
        with _overwrite_mode(spark, "static"):
            df.select(*columns).write.insertInto(table, overwrite=True)
        return "replaced"
    writer = df.write
    if partitions:
        writer = writer.partitionBy(*partitions)
    if BUCKET in partitions and buckets:
        # The count rides with the schema, so a later publish hashes alike.
        writer = writer.option(_BUCKETS_OPTION, str(buckets))
    writer.saveAsTable(table)
    return "created"


def publish_changed(df: DataFrame, table: str, keys: list[str], changed: DataFrame) -> int:
    """Rewrite only the hash buckets of ``table`` that hold a key of ``changed``; returns how many.

    ``df`` is the whole new content; its rows in other buckets are left where they are. Buckets
    that lose all their rows are dropped. The list of buckets is bounded by their number.
    """
    spark = df.sparkSession
    count = _bucket_count(table, spark)
    if count is None:
        raise ValueError(f"{table} is not partitioned by a hash bucket")
    _require_same_columns(df.withColumn(BUCKET, F.lit(0)), spark.table(table).columns, table)
    kinds = df.select(*keys).schema.fields
    typed = changed.select(*[F.col(f"`{k}`").cast(f.dataType).alias(k) for k, f in zip(keys, kinds, strict=True)])
    touched = {r[0] for r in with_bucket(typed, keys, count).select(BUCKET).distinct().take(count)}
    if not touched:
        return 0
    content = with_bucket(df, keys, count).filter(F.col(BUCKET).isin(sorted(touched)))
    with _overwrite_mode(spark, "dynamic"):
        gather(content, [F.col(BUCKET)]).select(*spark.table(table).columns).write.insertInto(table, overwrite=True)
    emptied = touched - {r[0] for r in content.select(BUCKET).distinct().take(count)}
    if emptied:
        spark.sql(f"alter table {table} drop if exists " + ", ".join(f"partition ({BUCKET}={b})" for b in sorted(emptied)))
    return len(touched)


_BUCKETS_OPTION = "feedlake.buckets"
_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _overwrite_mode(spark: SparkSession, mode: str):
    """``static`` replaces all partitions, ``dynamic`` those that get rows."""
    before = spark.conf.get(_OVERWRITE_MODE)
    spark.conf.set(_OVERWRITE_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_OVERWRITE_MODE, before)


def _bucket_count(table: str, spark: SparkSession) -> int | None:
    """Buckets that a published table hashes its keys into; None if it does not."""
    rows = spark.sql(f"describe table extended {table}").filter("col_name = 'Storage Properties'").collect()
    for row in rows:
        for entry in row.data_type.strip("[]").split(","):
            name, _, value = entry.strip().partition("=")
            if name == _BUCKETS_OPTION:
                return int(value)
    return None


_PUBLISHED = "feedlake.published"


def published_version(spark: SparkSession, table: str) -> str | None:
    """What the content of ``table`` was last marked as, None if it is new or unmarked."""
    if not spark.catalog.tableExists(table):
        return None
    found = spark.sql(f"show tblproperties {table}").filter(F.col("key") == _PUBLISHED).first()
    return found["value"] if found else None


def mark_published(spark: SparkSession, table: str, version: str | None) -> None:
    """Say which content ``table`` has, or, before it is replaced, that this is not known."""
    if version is None:
        spark.sql(f"alter table {table} unset tblproperties if exists ('{_PUBLISHED}')")
    else:
        spark.sql(f"alter table {table} set tblproperties ('{_PUBLISHED}' = '{version}')")


def same_columns(df: DataFrame, table: str) -> bool:
    """Whether ``table``, hashed into buckets, has just the columns of ``df`` besides, of the same types."""
    kinds = {c.lower(): kind for c, kind in df.dtypes}
    spark = df.sparkSession
    own = {c.lower(): kind for c, kind in spark.table(table).dtypes if c != BUCKET}
    return own == kinds and _bucket_count(table, spark) is not None


def _require_same_columns(df: DataFrame, columns: list[str], table: str) -> None:
    have, want = {c.lower() for c in df.columns}, {c.lower() for c in columns}
    if have != want:
        raise ValueError(
            f"{table}: missing columns {sorted(want - have)}, unknown columns {sorted(have - want)}"
        )
