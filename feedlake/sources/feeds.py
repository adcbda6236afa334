"""Change feeds as files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType

# Spark's names for "no such folder" and "a folder without data files".
_NOTHING_THERE = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def envelope(row: StructType) -> StructType:
    """Schema of a change feed over rows of type ``row``."""
    return StructType(
        [
            StructField("after", row),
            StructField("before", row),
            StructField("op", StringType()),
            StructField("ts_ms", LongType()),
        ]
    )


def read_feed(
    spark: SparkSession,
    path: str,
    row_schema: StructType | None = None,
    fmt: str = "parquet",
    **options,
) -> DataFrame | None:
    """One batch of changes. A feed without files is no error.

    It gives an empty frame if ``row_schema`` is known, else None. Without a schema the
    file footers decide; pass ``mergeSchema=True`` if they differ.
    """
    reader = spark.read.format(fmt).options(**options)
    if row_schema is not None:
        reader = reader.schema(envelope(row_schema))
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
    return None if row_schema is None else spark.createDataFrame([], envelope(row_schema))


def write_raw(feed: DataFrame, path: str, rows_per_file: int | None = None, mode: str = "append") -> None:
    """Land changes as Parquet files of at most ``rows_per_file`` rows."""
    writer = feed.write.mode(mode)
    if rows_per_file is not None:
        if rows_per_file < 1:
            raise ValueError("rows_per_file must be positive")
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
