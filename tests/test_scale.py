"""What must hold at any size: hot keys are split, scans are narrow, nothing is collected."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import plan
from feedlake.operators.latest import latest_per_key, with_group_max
from feedlake.operators.merge import merge
from feedlake.plans.apply import apply_changes

PACKAGE = Path(__file__).resolve().parents[1] / "feedlake"


@pytest.fixture
def small_partitions(spark):
    """Thresholds scaled down, so that a hot key of the test data counts as skewed."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def skewed_joins(df, n):
    """Joins that adaptive execution split for skew while computing ``df`` of ``n`` rows."""
    assert len(df.collect()) == n
    text = plan(df).split("Initial Plan")[0]
    return len(re.findall(r"(?:SortMergeJoin|ShuffledHashJoin)\(skew=true\)", text))


@pytest.fixture
def hot(spark, tmp_path):
    """60,000 rows, a third of them under key 7."""
    df = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 1000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
        F.lit(5).cast("long").alias("ts_ms"),
    )
    path = str(tmp_path / "hot")
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_hot_tie_is_split(spark, hot, small_partitions):
    # All rows of the hot key tie: all 20,000 stay, over several tasks.
    assert skewed_joins(latest_per_key(hot, ["k"]), 60000) == 1


def test_hot_key_without_ties_needs_no_split(spark, hot, small_partitions):
    timed = hot.withColumn("ts_ms", F.monotonically_increasing_id())
    out = latest_per_key(timed, ["k"])
    assert skewed_joins(out, 40001) == 0  # spread by time already


def test_hot_group_max_is_split(spark, hot, small_partitions):
    assert skewed_joins(with_group_max(hot, ["k"]), 60000) == 1


def test_hot_key_in_the_table_is_split(spark, hot, small_partitions):
    source = spark.range(0, 20000).select((F.col("id") + 1).alias("k"), F.lit("new").alias("v"), F.lit(6).alias("ts_ms"))
    merged = merge(hot, source, ["k"]).when_matched_update_all().to_df()
    assert skewed_joins(merged, 60000) >= 1


def test_hot_new_key_in_the_source_is_split(spark, hot, small_partitions):
    target = hot.filter("k > 1000 and k % 2 = 0")
    n = hot.filter("k = 7 or k % 2 = 1").count()
    merged = merge(target, hot, ["k"]).when_not_matched_insert_all().to_df()
    assert skewed_joins(merged, target.count() + n) >= 1


def test_hot_null_key_passes(spark, hot, small_partitions):
    nulls = hot.withColumn("k", F.when(F.col("k") != 7, F.col("k")))
    target = nulls.filter("k % 2 = 0 or k is null")
    merged = merge(target, nulls, ["k"]).when_matched_update_all().when_not_matched_insert_all().to_df()
    # 20,000 keyless rows of the table stay and as many of the source are added.
    assert skewed_joins(merged, 80000) >= 1
    assert merged.filter("k is null").count() == 40000


def test_merge_scans_keys_only_where_keys_suffice(spark, hot):
    changes = hot.withColumn("op", F.lit("u")).limit(10)
    text = plan(apply_changes(hot, changes, ["k"], tie_break=["v"]))
    scans = re.findall(r"ReadSchema: (struct<[^>]*>)", text)
    assert "struct<k:bigint>" in scans
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.fixture
def shuffled(spark, small_partitions):
    """Nothing is broadcast; the plan's exchanges are all there is to move."""


def _work(df, inputs):
    """(exchanges, joins, scans of each input) of the plan that ran; what is reused counts once."""
    df.collect()
    lines = [line.strip(" :+-*0123456789()") for line in plan(df).split("Initial Plan")[0].splitlines()]
    exchanges = [line for line in lines if line.startswith("Exchange")]
    joins = [line for line in lines if re.match(r"SortMergeJoin|ShuffledHashJoin", line)]
    scans = [line for line in lines if line.startswith("FileScan")]
    return len(exchanges), len(joins), [sum(i in scan for scan in scans) for i in inputs]


@pytest.fixture
def stored(spark, tmp_path):
    """(target, feed) as files, with ties on stored and new keys left out of the stored ones."""
    target = spark.range(0, 5000).selectExpr("id as k", "cast(id as string) as v", "1L as ts_ms")
    feed = spark.range(0, 9000, 3).selectExpr("id as k", "'n' as v", "if(id % 7 = 0, 'd', 'u') as op", "id % 5 as ts_ms")
    feed = feed.union(spark.range(6000, 6100).selectExpr("id as k", "'tied'", "'c'", "9L")).union(spark.range(6000, 6100).selectExpr("id", "'also'", "'c'", "9L"))
    for name, df in (("target", target), ("feed", feed)):
        df.write.parquet(f"{tmp_path}/{name}")
    return spark.read.parquet(f"{tmp_path}/target"), spark.read.parquet(f"{tmp_path}/feed")


def test_a_batch_is_applied_in_few_passes(spark, stored, shuffled):
    target, feed = stored
    exchanges, joins, scans = _work(apply_changes(target, feed, ["k"]), ("/target]", "/feed]"))
    assert exchanges <= 6 and joins <= 3 and scans[0] <= 2 and scans[1] <= 2
    settled = feed.filter("v <> 'also'")
    exchanges, joins, scans = _work(apply_changes(target, settled, ["k"], tie_break=["v"]), ("/target]", "/feed]"))
    assert exchanges <= 5 and joins <= 2 and scans[0] <= 2


def test_an_upsert_is_two_joins(spark, stored, shuffled):
    target, feed = stored
    source = feed.filter("v = 'n'")
    for on in (["k"], "t.k = s.k"):
        merged = merge(target, source.alias("s"), on).when_matched_update_all().when_not_matched_insert_all().to_df()
        exchanges, joins, scans = _work(merged, ("/target]",))
        assert exchanges <= 5 and joins == 2 and scans[0] <= 3  # one for rows without a key


def test_a_batch_of_few_keys_moves_few_rows(spark, tmp_path, small_partitions, monkeypatch):
    """One key in a hundred changes: the plan joins about that share of the table, and no more."""
    from feedlake.operators import pruning

    spark.range(0, 100_000).selectExpr("if(id % 1000 = 7, null, id) as k", "sha2(cast(id as string), 256) as v", "1L as ts_ms").write.parquet(f"{tmp_path}/t")
    spark.range(0, 1000).selectExpr("id * 100 as k", "'new' as v", "if(id % 2 = 0, 'd', 'u') as op", "2L as ts_ms").write.parquet(f"{tmp_path}/s")
    target, feed = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    source = feed.drop("op").alias("s")
    keys = [F.col("k")]
    assert pruning.prunes(target, keys, source, keys)
    some, rest = pruning.split(target, keys, pruning.bitmap(source, keys))
    assert 990 <= some.count() <= 1200 and some.count() + rest.count() == 100_000

    def results():
        return [
            sorted(map(str, df.collect()))
            for df in (
                merge(target, source, ["k"]).when_matched_delete().to_df(),
                merge(target, source, "t.k = s.k").when_matched_update_all().when_not_matched_insert_all().to_df(),
                merge(target, source.filter("k % 200 = 0").alias("s"), ["k"]).when_matched_delete("s.v = 'new'").to_df(),
                apply_changes(target, feed, ["k"]),
                apply_changes(target, feed, ["k"], tie_break=["v"], guard="ts_ms"),
            )
        ]

    pruned = results()
    text = plan(merge(target, source, ["k"]).when_matched_delete().to_df())
    assert "_fl_bitmap" in text and "BroadcastHashJoin" in text
    monkeypatch.setattr(pruning, "TIMES", 10**9)
    assert "_fl_bitmap" not in plan(merge(target, source, ["k"]).when_matched_delete().to_df())
    assert results() == pruned


def test_library_collects_no_data_and_runs_no_python_on_rows():
    """Driver reads are single-row metadata; no user-defined functions, no RDDs."""
    banned = re.compile(r"toPandas|\.rdd\b|udf|applyInPandas|mapInPandas|toLocalIterator|crossJoin|localCheckpoint")
    collects = {}
    for path in PACKAGE.rglob("*.py"):
        text = path.read_text()
        assert not banned.search(text), path
        if ".collect()" in text:
            collects[path.name] = text.count(".collect()")
    assert collects == {"table.py": 1, "publish.py": 1}  # table properties
