"""Arriving feed files, applied batch by batch.

The stream's checkpoint decides what a batch is: it moves on only after the batch has
been committed to the table, so a failed batch is tried again, and a batch that was
committed just before a failure is recognised by its label and not applied twice. The label
holds the id that the checkpoint gives its query, so after a new checkpoint at the same place,
whose batches are numbered from 0 again, nothing is taken for applied.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from feedlake.plans.apply import apply_batch
from feedlake.plans.config import TableConfig
from feedlake.plans.table import LakeTable
from feedlake.sources.layout import Layout
from feedlake.sources.feeds import envelope, read_feed
from feedlake.sources.storage import exists


def read_feed_stream(
    spark: SparkSession,
    path: str,
    schema,
    archive: str | None = None,
    max_files_per_batch: int | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Feed files as a stream. With ``archive``, files are moved there once a later batch
    (or run) has passed them. Files that arrive with an old time stamp are read all the
    same (Spark would pass over those a week older than the newest)."""
    reader = spark.readStream.schema(schema).option("maxFileAge", "36500d")
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.format(fmt).load(path)


def stream_apply(
    spark: SparkSession,
    config: TableConfig,
    raw_prefix: str,
    staged_prefix: str,
    checkpoint_prefix: str,
    archive: str | None = None,
    max_files_per_batch: int | None = None,
    database: str | None = None,
) -> LakeTable | None:
    """Apply all files that have arrived for one table; None if there is no table then.

    Returns when the backlog is done (``availableNow``); run it again on a timer.
    """
    raw = config.path(raw_prefix)
    table = table_of(spark, config, staged_prefix, database)
    if not exists(spark, raw):
        return _existing(table)
    if config.row_schema is not None:
        schema = envelope(config.row_schema)
    else:
        # The union of the columns of all files: a column that one file lacks is not lost.
        merged = {"mergeSchema": True} if config.format in ("parquet", "orc") else {}
        sample = read_feed(spark, raw, fmt=config.format, **merged)
        if sample is None:
            return _existing(table)
        schema = sample.schema
    checkpoint = config.path(checkpoint_prefix)

    replayed = True  # only the first batch of a run can be one that was committed before

    def apply(batch: DataFrame, batch_id: int) -> None:
        nonlocal replayed
        label = f"{query_id(spark, checkpoint)}#{batch_id}"
        if replayed and table.has_batch(label):
            return
        replayed = False
        apply_batch(
            table,
            batch,
            list(config.primary_keys),
            tie_break=config.tie_break,
            guard=config.guard,
            tombstones=config.tombstones,
            batch=label,
        )

    query = (
        read_feed_stream(spark, raw, schema, archive, max_files_per_batch, config.format)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _existing(table)


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gave its query; it is written before the first batch."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def table_of(
    spark: SparkSession, config: TableConfig, staged_prefix: str, database: str | None = None
) -> LakeTable:
    """The staged table of a config: sliced, bucketed (if a database is given) or neither."""
    buckets = config.staged_buckets if database else None
    layout = Layout()
    if buckets:
        layout = Layout(tuple(config.primary_keys), buckets, database)
    elif config.staged_slices:
        layout = Layout(tuple(config.primary_keys), slices=config.staged_slices)
    return LakeTable.at(spark, config.path(staged_prefix), layout)


def _existing(table: LakeTable) -> LakeTable | None:
    return table if table.version is not None else None
