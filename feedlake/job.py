"""A run over a stored table list, as one job.

    spark-submit feedlake/job.py '{"raw": "s3a://raw", "staged": "s3a://staged",
        "checkpoints": "s3a://state", "database": "curated",
        "tables": [{"topic_name": "shop.public.orders", "primary_keys": ["id"], "format": "json"}]}'

The argument is JSON, or the path of a JSON file in any store Spark reads. ``archive`` and
``staged_database`` may stand beside the paths. An entry of ``tables`` holds the settings of
``TableConfig`` (``row_schema`` as DDL text), and may override any of the paths and the database.
A job may also be one table: the entry itself, in which ``processing_prefix_path``,
``staged_prefix_path`` and ``glue_database`` are other names of raw, staged and database, and
``curated_path`` is where that database is made if it is not there. Checkpoints then lie beside the
staged tables unless told.
The job ends with an error if a table failed, after all others are done.
"""

from __future__ import annotations

import json
import sys

from pyspark.sql import SparkSession

from feedlake.plans.config import TableConfig
from feedlake.plans.run import Outcome, run_tables

_PLACES = {
    "raw": "raw_prefix",
    "staged": "staged_prefix",
    "checkpoints": "checkpoint_prefix",
    "database": "database",
    "archive": "archive",
    "staged_database": "staged_database",
}


_OTHER_NAMES = {"processing_prefix_path": "raw", "staged_prefix_path": "staged", "glue_database": "database", "curated_path": "curated"}


def _named(entry: dict) -> dict:
    """The settings under their own names; a setting given twice is an error."""
    out = {}
    for name, value in entry.items():
        name = _OTHER_NAMES.get(name, name)
        if name in out:
            raise ValueError(f"{name} is given under two names")
        out[name] = value
    return out


def _one_table(entry: dict) -> dict:
    if entry.get("staged"):
        entry.setdefault("checkpoints", f"{entry['staged'].rstrip('/')}/_checkpoints")
    return {"tables": [entry]}


def run_job(spark: SparkSession, argument: str) -> list[Outcome]:
    text = argument.strip()
    if not text.startswith("{"):
        text = spark.read.text(text, wholetext=True).first()[0]
    job = _named(json.loads(text))
    if "tables" not in job and ("topic_name" in job or "topic" in job):
        job = _one_table(job)
    unknown = set(job) - set(_PLACES) - {"tables", "curated"}
    if unknown:
        raise ValueError(f"unknown settings {sorted(unknown)}")
    outcomes = []
    for entry in map(_named, job["tables"]):
        places = {name: entry.get(name, job.get(name)) for name in _PLACES}
        missing = [name for name in ("raw", "staged", "checkpoints", "database") if not places[name]]
        if missing:
            raise ValueError(f"{entry.get('topic_name', entry.get('topic'))}: no {missing}")
        curated = entry.get("curated", job.get("curated"))
        if curated:
            spark.sql(f"create database if not exists {places['database']} location '{curated}'")
        config = TableConfig.from_dict({k: v for k, v in entry.items() if k not in _PLACES and k != "curated"})
        outcomes += run_tables(spark, [config], **{_PLACES[name]: place for name, place in places.items()})
    return outcomes


def main(arguments: list[str]) -> int:
    if len(arguments) != 1:
        sys.exit(__doc__)
    outcomes = run_job(SparkSession.builder.appName("feedlake").getOrCreate(), arguments[0])
    for o in outcomes:
        print(o.topic, o.status, "" if o.version is None else o.version, o.error or "")
    return int(any(o.status == "failed" for o in outcomes))


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
