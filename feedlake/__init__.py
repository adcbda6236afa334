"""Keep analytical tables current from change feeds, with Spark DataFrames."""

from feedlake.functions.timecols import normalize_timestamps
from feedlake.operators.diff import snapshot_diff
from feedlake.operators.flatten import flatten
from feedlake.operators.latest import latest_per_key, with_group_max
from feedlake.operators.merge import merge
from feedlake.operators.rowchanges import delete_where, update_where
from feedlake.plans.apply import apply_changes, effective_changes
from feedlake.plans.config import TableConfig
from feedlake.plans.run import run_tables
from feedlake.plans.table import LakeTable
from feedlake.sources.feeds import envelope, read_feed, write_raw
from feedlake.sources.layout import Layout
from feedlake.sources.publish import publish
from feedlake.streaming.stream import stream_apply

__all__ = [
    "LakeTable",
    "Layout",
    "TableConfig",
    "apply_changes",
    "delete_where",
    "effective_changes",
    "envelope",
    "flatten",
    "latest_per_key",
    "merge",
    "normalize_timestamps",
    "publish",
    "read_feed",
    "run_tables",
    "snapshot_diff",
    "stream_apply",
    "update_where",
    "with_group_max",
    "write_raw",
]
