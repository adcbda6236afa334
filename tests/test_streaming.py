import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import rows
from feedlake.functions.timecols import normalize_timestamps
from feedlake.operators.flatten import to_envelope
from feedlake.plans.apply import apply_batch, apply_changes
from feedlake.plans.config import TableConfig
from feedlake.plans.run import outcomes_frame, run_tables
from feedlake.plans.table import LakeTable
from feedlake.sources.feeds import write_raw
from feedlake.streaming.stream import stream_apply
from fixture_feeds import TIES_APPLIED, ties, ties_target

ROW = StructType([StructField("k", IntegerType()), StructField("v", StringType())])
FEED = "k int, v string, op string, ts_ms long"
ITEMS = TableConfig("shop.public.items", ["k"], row_schema=ROW)


@pytest.fixture
def lake(tmp_path):
    return {name: str(tmp_path / name) for name in ("raw", "staged", "checkpoints")}


def run(spark, lake, config=ITEMS, **options):
    return stream_apply(spark, config, lake["raw"], lake["staged"], lake["checkpoints"], **options)


def land(spark, lake, data, config=ITEMS):
    write_raw(to_envelope(spark.createDataFrame(data, FEED)).coalesce(1), config.path(lake["raw"]))


def test_runs_take_what_has_arrived(spark, lake):
    assert run(spark, lake) is None
    land(spark, lake, [(k, v, "r", ts) for k, v, ts in [(1, "A", 0), (2, "B", 0), (3, "C", 0), (4, "D", 0)]])
    assert run(spark, lake).version == 0
    write_raw(to_envelope(ties(spark)), ITEMS.path(lake["raw"]))
    table = run(spark, lake)
    assert table.version == 1 and rows(table.to_df()) == TIES_APPLIED
    assert run(spark, lake).version == 1  # nothing new, nothing done
    labels = [r["batch"].rsplit("#", 1)[1] for r in table.history().collect()]
    assert labels == ["1", "0"]


def test_stream_equals_batch(spark, lake):
    """Files in time order, one per micro-batch, against one batch."""
    changes = [(k, f"{k}-{ts}", op, ts) for ts, (k, op) in enumerate(
        [(1, "c"), (2, "c"), (1, "u"), (3, "c"), (2, "d"), (3, "u"), (2, "c"), (1, "d")])]
    for start in range(0, len(changes), 2):
        land(spark, lake, changes[start:start + 2])
        os.utime(ITEMS.path(lake["raw"]))
    table = run(spark, lake, max_files_per_batch=1)
    assert table.version == 3
    nothing = spark.createDataFrame([], "k int, v string, ts_ms long")
    assert rows(table.to_df()) == rows(apply_changes(nothing, spark.createDataFrame(changes, FEED), ["k"]))


def test_files_with_an_old_time_stamp_are_read(spark, lake):
    land(spark, lake, [(1, "A", "r", 1)])
    run(spark, lake)
    known = set(os.listdir(ITEMS.path(lake["raw"])))
    land(spark, lake, [(2, "B", "r", 1)])
    for name in set(os.listdir(ITEMS.path(lake["raw"]))) - known:
        os.utime(os.path.join(ITEMS.path(lake["raw"]), name), (1_000_000_000, 1_000_000_000))
    assert rows(run(spark, lake).to_df(), "k") == [(1,), (2,)]


def test_other_commits_between_runs(spark, lake):
    land(spark, lake, [(1, "A", "r", 1), (2, "B", "r", 1)])
    run(spark, lake).delete("k = 1")
    land(spark, lake, [(2, "b", "u", 2)])
    table = run(spark, lake)
    assert table.version == 2 and rows(table.to_df()) == [(2, "b", 2)]


def test_failed_batch_is_tried_again(spark, lake):
    land(spark, lake, [(1, "A", "r", 1)])
    run(spark, lake)
    land(spark, lake, [(1, "x", "u", 5), (1, "y", "u", 5)])
    with pytest.raises(Exception, match="MERGE_CARDINALITY_VIOLATION"):
        run(spark, lake)
    table = run(spark, lake, replace(ITEMS, tie_break=["v"]))
    assert rows(table.to_df()) == [(1, "y", 5)]


def test_batch_committed_just_before_a_failure_is_not_applied_again(spark, lake):
    land(spark, lake, [(None, "n", "c", 1)])
    table = run(spark, lake)
    # Commit made, checkpoint not yet: as if the driver died in between. Then another commit.
    for name in ("0", ".0.crc"):
        os.remove(os.path.join(ITEMS.path(lake["checkpoints"]), "commits", name))
    table.update(set={"v": "upper(v)"})
    assert rows(run(spark, lake).to_df()) == [(None, "N", 1)]
    land(spark, lake, [(1, "a", "c", 2)])
    assert rows(run(spark, lake).to_df()) == [(None, "N", 1), (1, "a", 2)]


def test_consumed_files_are_archived(spark, lake, tmp_path):
    archive = str(tmp_path / "archive")
    for k in (1, 2, 3):
        land(spark, lake, [(k, "v", "c", k)])
        run(spark, lake, archive=archive)
    moved = sum(f.endswith(".parquet") for _, _, names in os.walk(archive) for f in names)
    left = sum(f.endswith(".parquet") for _, _, names in os.walk(lake["raw"]) for f in names)
    assert moved + left == 3 and moved >= 1  # clean-up follows one batch behind
    assert run(spark, lake, archive=archive).to_df().count() == 3


def test_bucketed_staging(spark, lake, database):
    config = replace(ITEMS, staged_buckets=4)
    land(spark, lake, [(k, "v", "c", 1) for k in range(50)])
    land(spark, lake, [(k, "w", "u", 2) for k in range(0, 50, 5)])
    table = run(spark, lake, config, database=database, max_files_per_batch=1)
    assert rows(table.to_df().groupBy("v").count()) == [("v", 40), ("w", 10)]


def test_sliced_staging(spark, lake):
    config = replace(ITEMS, staged_slices="k div 10")
    land(spark, lake, [(k, "v", "c", 1) for k in range(50)])
    run(spark, lake, config)
    land(spark, lake, [(1, "w", "u", 2), (2, "w", "d", 2)])
    table = run(spark, lake, config)
    assert rows(table.to_df().groupBy("v").count()) == [("v", 48), ("w", 1)]
    assert rows(table.history(1), "rows_kept") == [(8,)]


def test_run_tables(spark, lake, database):
    items = TableConfig.from_dict({"topic_name": "shop.public.items", "primary_keys": ["k"], "big_table": "True"})
    empty = TableConfig.from_dict({"topic_name": "shop.public.empty", "primary_keys": ["k"]})
    broken = TableConfig("shop.public.broken", ["no_such_column"])
    tail = TableConfig("shop.public.tail", ["k"])
    for config in (items, broken, tail):
        land(spark, lake, [(1, "A", "r", 1), (2, "B", "r", 1)], config)

    def go():
        return run_tables(spark, [items, empty, broken, tail], lake["raw"], lake["staged"], lake["checkpoints"], database)

    first = go()
    assert [(o.topic.rsplit(".", 1)[1], o.status, o.version) for o in first] == [
        ("items", "created", 0), ("empty", "no data", None), ("broken", "failed", None), ("tail", "created", 0)]
    assert "no_such_column" in first[2].error
    land(spark, lake, [(1, "A", "d", 2), (3, "C", "c", 2)], items)
    assert [o.status for o in go()] == ["replaced", "no data", "failed", "unchanged"]
    assert rows(spark.table(f"{database}.shop_public_items"), "k", "v", "ts_ms") == [(2, "B", 1), (3, "C", 2)]
    assert rows(spark.table(f"{database}.shop_public_tail"), "k") == [(1,), (2,)]
    assert not spark.catalog.tableExists(f"{database}.shop_public_empty")
    assert outcomes_frame(spark, first).count() == 4


def test_stored_table_is_published_without_new_data(spark, lake, database):
    land(spark, lake, [(1, "A", "r", 1)])
    run(spark, lake)
    nothing_new = {**lake, "raw": lake["raw"] + "_gone"}
    outcome = run_tables(spark, [ITEMS], nothing_new["raw"], lake["staged"], lake["checkpoints"], database)[0]
    assert (outcome.status, outcome.version) == ("created", 0)
    assert rows(spark.table(f"{database}.shop_public_items")) == [(1, "A", 1)]


def test_publish_as_view_copies_nothing(spark, lake, database):
    config = replace(ITEMS, publish_view=True)
    for data, status in (([(1, "A", "r", 1)], "created"), ([(2, "B", "r", 2)], "replaced")):
        land(spark, lake, data)
        outcome = run_tables(spark, [config], lake["raw"], lake["staged"], lake["checkpoints"], database)[0]
        assert (outcome.status, outcome.error) == (status, None)
    published = spark.table(f"{database}.shop_public_items")
    assert rows(published, "k") == [(1,), (2,)]
    assert all("/staged/" in f for f in published.inputFiles())


def test_publish_with_time_columns(spark, lake, database):
    config = replace(ITEMS, timestamp_cols=["ts_ms"], ref_time_column="ts_ms", partition="month")
    land(spark, lake, [(1, "A", "r", 0), (2, "B", "r", 2_678_400_000)])
    for _ in range(2):
        assert run_tables(spark, [config], lake["raw"], lake["staged"], lake["checkpoints"], database)[0].error is None
    assert rows(spark.table(f"{database}.shop_public_items"), "k", "month") == [(1, "1970-01"), (2, "1970-02")]


def test_config():
    with pytest.raises(ValueError):
        TableConfig("items", ["k"])
    with pytest.raises(ValueError):
        TableConfig("shop.public.items", [])
    with pytest.raises(ValueError):
        TableConfig.from_dict({"topic_name": "shop.public.items", "primary_keys": ["k"], "nope": 1})
    text = {"topic_name": "shop.public.items", "primary_keys": ["k"], "big_table": "False"}
    assert TableConfig.from_dict(text).big_table is False
    assert TableConfig.from_dict({**text, "big_table": None}).big_table is False


def test_time_columns(spark):
    df = spark.createDataFrame([(0, 1_700_000_000_123)], "k int, at long")
    out = normalize_timestamps(df, ["at"], "at", "day", "yyyy-MM-dd")
    assert rows(out.select(F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSS"), "day")) == [
        ("2023-11-14 22:13:20.123", "2023-11-14")]
    assert rows(normalize_timestamps(df, [], "at", "month"), "month") == [("2023-11",)]
    with pytest.raises(ValueError):
        normalize_timestamps(df, [], None, "day")


def test_new_checkpoint_at_the_same_place_loses_nothing(spark, lake, tmp_path):
    land(spark, lake, [(1, "A", "r", 1)])
    run(spark, lake)
    os.rename(ITEMS.path(lake["checkpoints"]), tmp_path / "old_checkpoint")
    land(spark, lake, [(2, "B", "r", 1)])
    assert rows(run(spark, lake).to_df(), "k") == [(1,), (2,)]


def test_column_of_one_file_only(spark, lake):
    config = replace(ITEMS, row_schema=None)
    land(spark, lake, [(1, "A", "r", 1)], config)
    wide = spark.createDataFrame([(2, "B", "new", "c", 2)], "k int, v string, w string, op string, ts_ms long")
    write_raw(to_envelope(wide).coalesce(1), config.path(lake["raw"]))
    assert rows(run(spark, lake, config).to_df(), "k", "w") == [(1, None), (2, "new")]


def test_json_feed(spark, lake):
    config = replace(ITEMS, format="json")
    to_envelope(spark.createDataFrame([(1, "A", "r", 1), (2, "B", "c", 1)], FEED)).write.json(config.path(lake["raw"]))
    assert rows(run(spark, lake, config).to_df(), "k", "v") == [(1, "A"), (2, "B")]


def test_view_refuses_settings_it_would_ignore():
    with pytest.raises(ValueError, match="partition"):
        replace(ITEMS, publish_view=True, partition="day")


def test_publishing_rewrites_only_changed_buckets(spark, lake, database):
    config = replace(ITEMS, big_table=True, publish_buckets=16)

    def publish_all():
        return run_tables(spark, [config], lake["raw"], lake["staged"], lake["checkpoints"], database)[0]

    def files():
        return set(spark.table(f"{database}.shop_public_items").inputFiles())

    def current():
        return rows(spark.table(f"{database}.shop_public_items"), "k", "v")

    land(spark, lake, [(k, f"v{k}", "r", 0) for k in range(200)], config)
    assert publish_all().status == "created"
    first = files()
    land(spark, lake, [(3, "new", "u", 1), (500, "added", "c", 1), (7, "", "d", 1)], config)
    assert publish_all().status == "replaced"
    second = files()
    want = {k: f"v{k}" for k in range(200)} | {3: "new", 500: "added"}
    del want[7]
    assert current() == sorted(want.items())
    assert 13 <= len(first & second) < 16  # three keys lie in three buckets at most
    # All rows of a bucket go.
    bucket = spark.table(f"{database}.shop_public_items").filter("k = 3").first()["bucket"]
    gone = [r[0] for r in rows(spark.table(f"{database}.shop_public_items").filter(f"bucket = {bucket}"), "k")]
    land(spark, lake, [(k, "", "d", 2) for k in gone], config)
    publish_all()
    assert current() == sorted((k, v) for k, v in want.items() if k not in gone)
    assert second - files() and not files() - second
    # A commit whose keys were not kept is published as a whole.
    table = LakeTable.for_path(spark, config.path(lake["staged"]))
    table.update("k = 500", {"v": "'again'"})
    publish_all()
    assert not files() & second and (500, "again") in current()


def test_job_of_one_table_under_other_names(spark, lake, tmp_path):
    import json

    from feedlake.job import run_job

    land(spark, lake, [(1, "a", "c", 1)])
    name = f"curated_{tmp_path.name}".replace("-", "_")
    job = {"processing_prefix_path": lake["raw"], "staged_prefix_path": lake["staged"], "curated_path": str(tmp_path / "curated"),
           "glue_database": name, "topic_name": "shop.public.items", "primary_keys": ["k"], "big_table": "True",
           "timestamp_cols": None, "ref_time_column": None, "partition": None}
    assert run_job(spark, json.dumps(job))[0].status == "created"
    assert rows(spark.table(f"{name}.shop_public_items"), "k", "v") == [(1, "a")]
    assert (tmp_path / "curated" / "shop_public_items").exists()
    with pytest.raises(ValueError, match="two names"):
        run_job(spark, json.dumps(job | {"raw": "x"}))
