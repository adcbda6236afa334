"""One timed run: bring every configured table up to date, then publish it."""

from __future__ import annotations

import hashlib
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from feedlake.functions.timecols import normalize_timestamps
from feedlake.plans.config import TableConfig
from feedlake.plans.table import LakeTable
from feedlake.sources.publish import mark_published, publish, publish_changed, published_version, same_columns
from feedlake.streaming.stream import stream_apply

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    topic: str
    status: str  # created, replaced, unchanged, no data, failed
    version: int | None = None
    error: str | None = None


def publish_table(config: TableConfig, table: LakeTable, database: str) -> str:
    """Publish the current snapshot as ``<database>.<topic with . as _>``.

    Nothing is rewritten if that snapshot, with the same settings, was published last.
    """
    name = f"{database}.{config.catalog_name}"
    if config.publish_view:
        status = "replaced" if table.spark.catalog.tableExists(name) else "created"
        table.register(name)
        return status
    settings = (config.timestamp_cols, config.ref_time_column, config.partition)
    digest = hashlib.sha256(repr(settings).encode()).hexdigest()[:16]
    mark, before = f"{table.root}#{table.version}#{digest}", published_version(table.spark, name)
    if before == mark:
        return "unchanged"
    if table.spark.catalog.tableExists(name):
        mark_published(table.spark, name, None)
    content = normalize_timestamps(
        table.to_df(), config.timestamp_cols, config.ref_time_column, config.partition
    )
    changed = None
    if config.big_table and not config.partition:
        changed = _changed_since(table, before, digest, list(config.primary_keys))
    if changed is not None and same_columns(content, name):
        publish_changed(content, name, list(config.primary_keys), changed)
        mark_published(table.spark, name, mark)
        return "replaced"
    status = publish(
        content,
        name,
        partition_by=[config.partition] if config.partition else None,
        keys=list(config.primary_keys) if config.big_table else None,
        buckets=config.publish_buckets if config.big_table else None,
    )
    mark_published(table.spark, name, mark)
    return status


def _changed_since(table: LakeTable, mark: str | None, digest: str, keys: list[str]) -> DataFrame | None:
    """The keys changed since the version that ``mark`` names; None if that is not known."""
    if mark is None:
        return None
    root, version, settings = mark.rsplit("#", 2)
    if root != table.root or settings != digest or not version.isdigit():
        return None
    return table.changed_keys(int(version), keys)


def run_tables(
    spark: SparkSession,
    configs: list[TableConfig],
    raw_prefix: str,
    staged_prefix: str,
    checkpoint_prefix: str,
    database: str,
    archive: str | None = None,
    staged_database: str | None = None,
) -> list[Outcome]:
    """Tables run one after the other; one that fails is reported and the rest go on.

    A table without data is left out of publishing. A failed batch stays unconsumed.
    """
    outcomes = []
    for config in configs:
        try:
            table = stream_apply(
                spark, config, raw_prefix, staged_prefix, checkpoint_prefix, archive, database=staged_database
            )
            if table is None:
                log.info("%s: no data", config.topic)
                outcomes.append(Outcome(config.topic, "no data"))
                continue
            status = publish_table(config, table, database)
            outcomes.append(Outcome(config.topic, status, table.version))
        except Exception as error:  # any failure of one table must not stop the others
            log.exception("%s failed", config.topic)
            outcomes.append(Outcome(config.topic, "failed", error=str(error)))
    return outcomes


def outcomes_frame(spark: SparkSession, outcomes: list[Outcome]) -> DataFrame:
    rows = [(o.topic, o.status, o.version, o.error) for o in outcomes]
    return spark.createDataFrame(rows, "topic string, status string, version int, error string")
