"""From the change envelope (after, before, op, ts_ms) to flat change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

# Operation codes of the change envelope.
UPSERT_OPS = ["r", "c", "u"]  # full load, insert, update
DELETE_OPS = ["d"]
CONTROL_COLUMNS = ["op", "ts_ms"]


def upserts(df: DataFrame) -> DataFrame:
    """Full-load, insert and update rows; unknown or null codes are left out."""
    return df.filter(F.col("op").isin(UPSERT_OPS))


def deletes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("op").isin(DELETE_OPS))


def _row_type(feed: DataFrame, image: str) -> StructType:
    row = feed.schema[image].dataType
    if not isinstance(row, StructType):
        raise TypeError(f"{image} must be a struct, got {row.simpleString()}")
    clash = [f for f in row.fieldNames() if f.lower() in CONTROL_COLUMNS]
    if clash:
        raise ValueError(f"row columns {clash} collide with the control columns {CONTROL_COLUMNS}")
    return row


def after_images(feed: DataFrame) -> DataFrame:
    """``after.*, op, ts_ms``."""
    _row_type(feed, "after")
    return feed.select("after.*", *CONTROL_COLUMNS)


def before_images(feed: DataFrame) -> DataFrame:
    """``before.*, op, ts_ms``."""
    _row_type(feed, "before")
    return feed.select("before.*", *CONTROL_COLUMNS)


def drop_control(df: DataFrame, *extra: str) -> DataFrame:
    """Drop ``op`` and helper columns; ``ts_ms`` stays part of the row."""
    return df.drop("op", *extra)


def flatten(feed: DataFrame) -> DataFrame:
    """One flat row per change: the old image of deletes, the new image of all else.

    Images are matched by column name; a column that one image lacks is null there.
    The feed is read once, and since every field is taken on its own, unused fields
    are pruned from the scan.
    """
    after, before = _row_type(feed, "after"), _row_type(feed, "before")
    is_delete = F.col("op").isin(DELETE_OPS)
    names = after.fieldNames() + [n for n in before.fieldNames() if n not in after.fieldNames()]
    columns = []
    for name in names:
        kind = (after if name in after.fieldNames() else before)[name].dataType
        old = F.col("before").getField(name) if name in before.fieldNames() else F.lit(None)
        new = F.col("after").getField(name) if name in after.fieldNames() else F.lit(None)
        columns.append(F.when(is_delete, old.cast(kind)).otherwise(new.cast(kind)).alias(name))
    return feed.filter(F.col("op").isin(UPSERT_OPS + DELETE_OPS)).select(*columns, *CONTROL_COLUMNS)


def to_envelope(changes: DataFrame) -> DataFrame:
    """Flat changes as envelope rows: deletes carry ``before`` only, updates carry both."""
    row = F.struct(*[F.col(c) for c in changes.columns if c not in CONTROL_COLUMNS])
    op = F.col("op")
    return changes.select(
        F.when(op.isin(UPSERT_OPS), row).alias("after"),
        F.when(op.isin(["u"] + DELETE_OPS), row).alias("before"),
        *CONTROL_COLUMNS,
    )
