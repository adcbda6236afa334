import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from feedlake.operators.diff import snapshot_diff
from feedlake.plans.apply import apply_batch, merge_effective
from feedlake.plans.table import LakeTable
from feedlake.sources.layout import SLICE, Layout
from feedlake.sources.publish import BUCKET, publish
from fixture_feeds import TIES_APPLIED, ties, ties_target

ROW = "k int, v string, ts_ms long"
FEED = "k int, v string, op string, ts_ms long"


def test_life_of_a_table(spark, tmp_path):
    root = str(tmp_path / "t")
    assert not LakeTable.is_table(spark, root)
    with pytest.raises(ValueError):
        LakeTable.for_path(spark, root)
    table = LakeTable.at(spark, root)
    assert table.create(ties_target(spark)) == 0
    assert apply_batch(table, ties(spark), ["k"]) == 1
    assert LakeTable.is_table(spark, root)
    assert rows(LakeTable.for_path(spark, root).to_df()) == TIES_APPLIED
    assert table.delete("v = 'C'") == 2
    assert table.update(set={"v": "upper(v)"}, condition="k is not null") == 3
    assert rows(table.to_df(), "v") == [("C",), ("I",), ("g",)]
    fresh = spark.createDataFrame([(2, "two", 9), (7, "seven", 9)], ROW).alias("fresh")
    merge = table.alias("stored").merge(fresh, "stored.k = fresh.k")
    version = (merge.when_matched_update(set={"v": "fresh.v"})
               .when_not_matched_insert("fresh.k > 0", {"k": "fresh.k", "v": "fresh.v"}).execute())
    assert version == 4
    assert rows(table.to_df()) == [(None, "g", 3), (2, "two", 7), (5, "I", 1), (7, "seven", None)]
    history = table.history().drop("committed_at", "batch")
    counts = "rows_inserted rows_updated rows_deleted rows_kept".split()
    assert rows(history, "version", "operation", *counts) == [
        (0, "create", 4, 0, 0, 0), (1, "merge", 2, 1, 2, 1), (2, "delete", 0, 0, 1, 3), (3, "update", 0, 2, 0, 1),
        (4, "merge", 1, 1, 0, 2)]
    assert [r["version"] for r in table.history(2).collect()] == [4, 3]
    # Older snapshots stay as they were.
    assert rows(table.snapshot(1)) == TIES_APPLIED


def test_uncommitted_snapshot_is_invisible_and_overwritten(spark, tmp_path):
    table = LakeTable.at(spark, str(tmp_path / "t"))
    table.create(ties_target(spark))
    # A run that died after writing data and before recording the commit.
    spark.createDataFrame([(99, "junk", 0)], ROW).write.parquet(f"{table.root}/snapshot=1")
    assert table.version == 0 and rows(table.to_df()) == rows(ties_target(spark))
    assert apply_batch(table, ties(spark), ["k"]) == 1
    assert rows(table.to_df()) == TIES_APPLIED


def test_batch_labels(spark, tmp_path):
    table = LakeTable.at(spark, str(tmp_path / "t"))
    assert not table.has_batch("run#0")
    apply_batch(table, ties(spark), ["k"], batch="run#0")
    table.delete("k = 1")
    assert table.has_batch("run#0") and not table.has_batch("run#1")


def test_failed_merge_commits_nothing(spark, tmp_path):
    table = LakeTable.at(spark, str(tmp_path / "t"))
    table.create(ties_target(spark))
    tied = spark.createDataFrame([(1, "x", "u", 5), (1, "y", "u", 5)], FEED)
    with pytest.raises(Exception, match="MERGE_CARDINALITY_VIOLATION"):
        apply_batch(table, tied, ["k"])
    assert table.version == 0 and rows(table.to_df()) == rows(ties_target(spark))


def test_registered_name_follows_commits(spark, tmp_path, database):
    table = LakeTable.at(spark, str(tmp_path / "t"))
    table.create(ties_target(spark))
    table = table.register(f"{database}.orders")
    table.delete("k = 1")
    assert rows(spark.table(f"{database}.orders"), "k") == [(2,), (3,), (4,)]
    by_name = LakeTable.for_name(spark, f"{database}.orders")
    by_name.delete("k = 2")
    assert rows(spark.table(f"{database}.orders"), "k") == [(3,), (4,)]
    spark.sql(f"create view {database}.plain as select 1 as x")
    with pytest.raises(ValueError):
        LakeTable.for_name(spark, f"{database}.plain")


def test_convert(spark, tmp_path):
    old = str(tmp_path / "old")
    spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "k int, v string, day int").write.partitionBy("day").parquet(old)
    plain = LakeTable.convert(spark, old, str(tmp_path / "plain"))
    assert rows(plain.to_df()) == [(1, "a", 7), (2, "b", 8)]
    typed = LakeTable.convert(spark, old, str(tmp_path / "typed"), "day string")
    assert rows(typed.to_df()) == [(1, "a", "7"), (2, "b", "8")]
    with pytest.raises(ValueError):
        LakeTable.convert(spark, old, str(tmp_path / "typed"))
    with pytest.raises(ValueError):
        LakeTable.convert(spark, old, str(tmp_path / "other"), "nope string")


def test_adopted_where_it_lies(spark, tmp_path, database):
    old = str(tmp_path / "old")
    spark.createDataFrame([(1, "a", 7), (2, "b", 8)], "k int, v string, day int").write.partitionBy("day").parquet(old)
    before = {str(f): f.stat().st_mtime_ns for f in (tmp_path / "old").rglob("*.parquet")}
    table = LakeTable.adopt(spark, old, str(tmp_path / "new"), "day string")
    assert rows(LakeTable.for_path(spark, table.root).to_df()) == [(1, "a", "7"), (2, "b", "8")]
    assert not (tmp_path / "new" / "snapshot=0").exists()
    table = table.register(f"{database}.t")
    assert rows(spark.table(f"{database}.t")) == [(1, "a", "7"), (2, "b", "8")]
    assert len(spark.sql(f"show partitions {database}.t__adopted").collect()) == 2
    source = spark.createDataFrame([(2, "x", "9"), (3, "c", "9")], "k int, v string, day string").alias("s")
    table.merge(source, "t.k = s.k").when_matched_update_all().when_not_matched_insert_all().execute()
    assert rows(spark.table(f"{database}.t")) == [(1, "a", "7"), (2, "x", "9"), (3, "c", "9")]
    assert rows(table.history(), "version", "operation", "rows_inserted") == [(0, "adopt", 2), (1, "merge", 1)]
    assert rows(table.snapshot(0)) == [(1, "a", "7"), (2, "b", "8")]
    assert {str(f): f.stat().st_mtime_ns for f in (tmp_path / "old").rglob("*.parquet")} == before
    with pytest.raises(ValueError):
        LakeTable.adopt(spark, old, table.root)
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert LakeTable.adopt(spark, plain, str(tmp_path / "p")).register(f"{database}.p").to_df().count() == 3
    assert spark.table(f"{database}.p").count() == 3


def test_bucketed_table_is_merged_and_compared_without_moving_it(spark, tmp_path, database):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet").selectExpr(
        "o_orderkey as k", "o_orderstatus as st", "1L as ts_ms")
    with pytest.raises(ValueError):
        Layout(("k",), buckets=4)
    # Fewer buckets than shuffle partitions: the batch must follow the table, not the reverse.
    table = LakeTable.at(spark, str(tmp_path / "orders"), Layout(("k",), 4, database))
    table.create(orders)
    changes = orders.selectExpr("k + 5000 as k", "'N' as st", "'u' as op", "2L as ts_ms")
    apply_batch(table, changes, ["k"])
    assert rows(table.to_df().groupBy("st", "ts_ms").count()) == rows(
        orders.filter("k < 5000").groupBy("st", "ts_ms").count().union(
            changes.groupBy("st", "ts_ms").count()))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        effective = spark.read.parquet(f"{table.root}/changes/version=1")
        merged = merge_effective(table.snapshot(0), effective, ["k"], gather_by=[F.col("k")]).to_df()
        assert _exchanges_over(plan(merged), "snapshot=0") == 0
        assert plan(merged).count("Bucketed: true") == 2  # whole rows once, keys once
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    diff = snapshot_diff(table.snapshot(0), table.snapshot(1), ["k"], 3)
    assert "Exchange" not in plan(diff)
    assert diff.count() == 15000
    # Without a catalog entry the same files are read as plain Parquet.
    known = rows(table.to_df())
    spark.sql(f"drop table {table._bucketed_name(1)}")
    assert rows(LakeTable.for_path(spark, table.root).to_df()) == known


@pytest.mark.parametrize("slices", ["k div 10", 5])
def test_sliced_table_rewrites_only_what_a_batch_touches(spark, tmp_path, slices):
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices=slices))
    table.create(spark.range(50).selectExpr("cast(id as int) as k", "'a' as v", "1L as ts_ms"))
    batch = [(3, "u", "u", 2), (4, "gone", "d", 2), (77, "new", "c", 2), (None, "n", "c", 2)]
    assert apply_batch(table, spark.createDataFrame(batch, FEED), ["k"]) == 1
    expected = {k: ("a", 1) for k in range(50)} | {3: ("u", 2), 77: ("new", 2), None: ("n", 2)}
    del expected[4]
    assert dict((k, (v, t)) for k, v, t in rows(table.to_df())) == expected
    if slices == "k div 10":
        pending = spark.read.parquet(f"{table.root}/pending/version=1")
        assert rows(pending.select(SLICE).distinct()) == [(-1,), (0,), (7,)]
        # Only slice 0 of the old snapshot was read: its nine kept rows are counted.
        assert rows(table.history(1), "rows_inserted", "rows_updated", "rows_deleted", "rows_kept") == [(2, 1, 1, 8)]
    # Emptied slices lose their rows; others are untouched.
    table.delete("k < 10 or k is null")
    assert rows(table.to_df(), "k") == sorted((k,) for k in expected if k is not None and k >= 10)
    table.update("k = 77", {"v": "'z'"})
    assert rows(table.to_df().filter("v = 'z'"), "k") == [(77,)]
    table.delete()
    assert table.to_df().count() == 0 and table.to_df().columns == ["k", "v", "ts_ms"]
    apply_batch(table, spark.createDataFrame(batch, FEED), ["k"])
    assert rows(table.to_df(), "k") == [(None,), (3,), (77,)]


def test_sliced_table_merges_and_registers(spark, tmp_path, database):
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 10"))
    table.create(spark.range(30).selectExpr("cast(id as int) as k", "'a' as v", "1L as ts_ms"))
    table = table.register(f"{database}.t")
    source = spark.createDataFrame([(5, "x", 2), (40, "y", 2)], ROW).alias("s")
    table.merge(source, "t.k = s.k").when_matched_update_all().when_not_matched_insert_all().execute()
    assert rows(spark.table(f"{database}.t").filter("v <> 'a'"), "k", "v") == [(5, "x"), (40, "y")]
    assert spark.table(f"{database}.t").count() == 31
    assert plan(spark.table(f"{database}.t")).count("FileScan") == 1
    table = LakeTable.for_name(spark, f"{database}.t")
    table.update("k = 5", {"v": "'z'"})
    table.delete("k < 5 or k > 5")
    assert rows(spark.table(f"{database}.t"), "k", "v") == [(5, "z")]
    table.delete()
    assert spark.table(f"{database}.t").count() == 0
    assert {t.name for t in spark.catalog.listTables(database)} == {"t", "t__data"}
    with pytest.raises(ValueError, match="current rows only"):
        table.snapshot(1)
    with pytest.raises(ValueError):
        Layout(slices=3)
    with pytest.raises(ValueError):
        Layout(("k",), buckets=2, database="d", slices=3)


def test_rows_of_a_sliced_table_may_change_their_keys(spark, tmp_path):
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 10"))
    table.create(spark.createDataFrame([(1, "a", 0), (11, "b", 0), (21, "c", 0)], ROW))
    table.update("v = 'a'", {"K": "k + 100"})
    assert rows(table.to_df(), "k", "v") == [(11, "b"), (21, "c"), (101, "a")]
    source = spark.createDataFrame([(31, "b", 1), (41, "c", 1)], ROW).alias("s")
    table.merge(source, "t.v = s.v").when_matched_update_all().execute()
    assert rows(table.to_df(), "k", "v") == [(31, "b"), (41, "c"), (101, "a")]
    table.merge(source, "t.v = s.v").when_matched_update(set={"k": "t.k + 10"}).execute()
    assert rows(table.to_df(), "k", "v") == [(41, "b"), (51, "c"), (101, "a")]
    table.merge(source, ["v"]).when_matched_update(set={"ts_ms": "5"}).execute()
    assert rows(table.to_df()) == [(41, "b", 5), (51, "c", 5), (101, "a", 0)]
    assert rows(spark.read.parquet(f"{table.root}/pending/version=4").select(SLICE).distinct()) == [(4,), (5,)]


def test_a_table_keeps_its_layout(spark, tmp_path):
    root = str(tmp_path / "t")
    LakeTable.at(spark, root, Layout(("k",), slices="k div 10")).create(ties_target(spark))
    # Slices cut otherwise would not find the stored rows.
    for other in (Layout(("k",), slices="k div 100"), Layout(("k",), slices=10)):
        with pytest.raises(ValueError, match="laid out"):
            LakeTable.at(spark, root, other)
    for table in (LakeTable.at(spark, root), LakeTable.for_path(spark, root)):
        assert table.layout == Layout(("k",), slices="k div 10")
    apply_batch(LakeTable.at(spark, root), ties(spark), ["k"])
    assert rows(LakeTable.at(spark, root).to_df()) == TIES_APPLIED


def test_sliced_batch_reads_only_its_slices(spark, tmp_path):
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 10"))
    table.create(spark.range(300).selectExpr("cast(id as int) as k", "'a' as v", "1L as ts_ms"))
    touched = table.stage(table.slices_of(spark.createDataFrame([(13,), (14,)], "k long")), 1, "touched")
    assert rows(table.in_slices(touched), "k") == [(k,) for k in range(10, 20)]
    pruned = table.in_slices(touched)
    pruned.collect()
    assert "dynamicpruning" in plan(pruned)


def test_unfinished_commit_of_a_sliced_table(spark, tmp_path, monkeypatch):
    """A writer dies at either point; the next one finishes what was announced, and no more."""
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 10"))
    table.create(spark.range(30).selectExpr("cast(id as int) as k", "'a' as v", "1L as ts_ms"))
    batch = spark.createDataFrame([(3, "u", "u", 2), (14, "x", "d", 2), (None, "n", "c", 2)], FEED)

    def dies(*_):
        raise RuntimeError("lost")

    overwrite = LakeTable._overwrite
    monkeypatch.setattr(LakeTable, "_overwrite", dies)
    with pytest.raises(RuntimeError):
        apply_batch(table, batch, ["k"], batch="run#0")
    assert table.version == 0 and table.to_df().filter("v <> 'a'").count() == 0
    monkeypatch.setattr(LakeTable, "_overwrite", overwrite)
    assert table.has_batch("run#0") and table.version == 1
    assert rows(table.to_df().filter("v <> 'a'")) == [(None, "n", 2), (3, "u", 2)] and table.to_df().count() == 30
    # Killed before the announcement: what lies aside is overwritten.
    spark.createDataFrame([(99, "junk", 0, True, 9)], f"{ROW}, fl_held boolean, fl_slice long").write.partitionBy(SLICE).parquet(f"{table.root}/pending/version=2")
    assert table.delete("k = 3") == 2
    assert table.to_df().count() == 29 and table.to_df().filter("v = 'junk'").count() == 0


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_sliced_batch_makes_few_files(spark, tmp_path, threshold):
    """Changed rows and the rows beside them are gathered by slice, however the join is planned."""
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 1000"))
    table.create(spark.range(20000).selectExpr("cast(id as int) as k", "'a' as v", "1L as ts_ms"))
    changes = spark.range(0, 30000, 7).selectExpr("cast(id as int) as k", "'b' as v", "'u' as op", "2L as ts_ms")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        apply_batch(table, changes, ["k"])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    files = [f for f in table.to_df().inputFiles()]
    assert len({f.split(SLICE)[1].split("/")[0] for f in files}) == 30 and len(files) <= 90  # one more a slice for the mark
    assert table.to_df().count() == 20000 + len(range(20006, 30000, 7))


def test_sliced_table_writes_each_slice_once_a_commit(spark, tmp_path):
    """No second file for the mark of a slice, and no second copy of a first load."""
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices="k div 10"))
    leftover = spark.createDataFrame([(99, "junk", 0, True, 9)], f"{ROW}, fl_held boolean, fl_slice long")
    leftover.write.partitionBy(SLICE).parquet(f"{table.root}/data")  # of a writer that died before its first commit
    apply_batch(table, spark.range(90).selectExpr("cast(id as int) as k", "'a' as v", "'c' as op", "1L as ts_ms"), ["k"])
    assert table.to_df().count() == 90 and table.to_df().filter("v = 'junk'").count() == 0
    assert not (tmp_path / "t" / "pending").exists()
    changes = spark.range(0, 90, 5).selectExpr("cast(id as int) as k", "'b' as v", "'u' as op", "2L as ts_ms")
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    apply_batch(table, changes, ["k"])
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert len(spark.read.parquet(f"{table.root}/pending/version=1").inputFiles()) == 9
    assert table.to_df().count() == 90 and table.to_df().filter("v = 'b'").count() == 18


def _exchanges_over(text, leaf):
    """Exchanges on the way from the plan's root to any scan of ``leaf``."""
    path, found = [], 0
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, n) for d, n in path if d < depth] + [(depth, line.strip(" :+-"))]
        if leaf in line:
            found += sum(n.startswith("Exchange") for _, n in path)
    return found


def test_publish_by_name(spark, database):
    name = f"{database}.orders"
    df = spark.createDataFrame([(1, 10, 100), (2, 20, 200)], "id int, a int, ts int")
    assert publish(df, name, partition_by=["id"]) == "created"
    assert publish(df, name) == "replaced"
    assert rows(spark.table(name), "id", "a", "ts") == [(1, 10, 100), (2, 20, 200)]
    assert publish(df.select("ts", "id", "a").filter("id = 2"), name.upper()) == "replaced"
    assert rows(spark.table(name), "id", "a", "ts") == [(2, 20, 200)]
    with pytest.raises(ValueError):
        publish(df.drop("ts"), name)


def test_publish_replaces_everything_whatever_the_session_says(spark, database):
    name = f"{database}.orders"
    df = spark.createDataFrame([(1, 10), (2, 20)], "id int, a int")
    publish(df, name, partition_by=["id"])
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        publish(df.filter("id = 2"), name)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(spark.table(name), "id", "a") == [(2, 20)]


def test_publish_by_bucket(spark, database):
    name = f"{database}.orders"
    df = spark.range(1000).withColumn("v", F.lit("x"))
    publish(df, name, keys=["id"], buckets=4)
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == [BUCKET]
    first = rows(spark.table(name), "id", BUCKET)
    assert {b for _, b in first} == {0, 1, 2, 3}
    # The table keeps its bucket count, whatever a later call asks for.
    publish(df, name, keys=["id"], buckets=16)
    assert rows(spark.table(name), "id", BUCKET) == first
    with pytest.raises(ValueError):
        publish(df, name)


def test_publish_unpartitioned_and_empty(spark, database):
    name = f"{database}.plain"
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    publish(df, name)
    publish(df.filter("false"), name)
    assert spark.table(name).count() == 0


def test_source_that_changes_between_reads(spark, tmp_path):
    """Inserts keyed by the time of reading, into a sliced table: every one arrives."""
    table = LakeTable.at(spark, str(tmp_path / "t"), Layout(("k",), slices=16))
    table.create(spark.range(1000).selectExpr("id as k", "'old' as v"))
    source = spark.range(50).selectExpr("unix_micros(current_timestamp()) * 100 + id as k", "'new' as v")
    table.merge(source, ["k"]).when_not_matched_insert_all().execute()
    assert table.to_df().count() == 1050
    table.merge(source.alias("s"), "t.k = s.k").when_not_matched_insert_all().execute()
    assert table.to_df().count() == 1100


def test_tables_of_one_name_are_apart(spark, tmp_path, database):
    for place, rows_there in (("a", 3), ("b", 5)):
        table = LakeTable.at(spark, str(tmp_path / place / "orders"), Layout(("k",), 2, database))
        table.create(spark.range(rows_there).withColumnRenamed("id", "k"))
    assert LakeTable.for_path(spark, str(tmp_path / "a" / "orders")).to_df().count() == 3


def test_column_named_as_the_bucket(spark, database):
    df = spark.range(100).selectExpr("id as k", "id as bucket")
    with pytest.raises(ValueError, match="bucket"):
        publish(df, f"{database}.clash", keys=["k"], buckets=4)
    publish(df.drop("bucket"), f"{database}.clash", keys=["k"], buckets=4)
    with pytest.raises(ValueError, match="bucket"):
        publish(df, f"{database}.clash", keys=["k"])
