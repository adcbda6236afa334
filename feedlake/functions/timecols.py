"""Epoch-millisecond columns as timestamps, and a partition column from one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def normalize_timestamps(
    df: DataFrame,
    timestamp_cols: list[str],
    ref_time_column: str | None = None,
    partition: str | None = None,
    partition_format: str = "yyyy-MM",
) -> DataFrame:
    """Turn epoch-ms columns into timestamps; derive ``partition`` from ``ref_time_column``.

    The partition text is in the session time zone, so run with UTC.
    """
    out = df.withColumns({c: F.timestamp_millis(F.col(c)) for c in timestamp_cols})
    if partition is None:
        return out
    if ref_time_column is None:
        raise ValueError("partition needs ref_time_column")
    ref = F.col(ref_time_column)
    if dict(out.dtypes)[ref_time_column] == "bigint":
        ref = F.timestamp_millis(ref)
    return out.withColumn(partition, F.date_format(ref, partition_format))
