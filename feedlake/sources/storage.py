"""Folder metadata through Spark's own Hadoop file system, so any shared store works."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def set_aside(spark: SparkSession, path: str, other: str) -> None:
    """Give the folder ``path`` another name."""
    fs, p = _path(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(other)):
        raise OSError(f"cannot rename {path} to {other}")


def newest_folder(spark: SparkSession, root: str, name: str, most: int | None = None) -> int | None:
    """Highest n, ``most`` at most, whose folder ``<root>/<name>=<n>`` is finished, None if there is none."""
    fs, p = _path(spark, root)
    if not fs.exists(p):
        return None
    found = (re.fullmatch(rf"{name}=(\d+)", s.getPath().getName()) for s in fs.listStatus(p))
    for number in sorted((int(m[1]) for m in found if m), reverse=True):
        if (most is None or number <= most) and exists(spark, f"{root}/{name}={number}/_SUCCESS"):
            return number
    return None


def repeatable(df: DataFrame, root: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder; its columns keep their aliases.

    Where the cluster names no such folder, one under ``root`` serves.
    """
    context = df.sparkSession.sparkContext
    if df.sparkSession.conf.get("spark.checkpoint.dir", None) is None and context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{root}/checkpoints")
    return df.checkpoint()
