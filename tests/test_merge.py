import re

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from conftest import plan, rows
from feedlake.operators.merge import merge
from feedlake.operators.rowchanges import ACTION, delete_where, update_where

SCHEMA = "k int, v string, n int"


def table(spark):
    return spark.createDataFrame([(1, "A", 10), (3, "C", 30), (None, "N", 0)], SCHEMA)


def source(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA).alias("s")


KEYED = ["k"]
PREDICATE = "t.k = s.k"
both = pytest.mark.parametrize("on", [KEYED, PREDICATE], ids=["keys", "predicate"])


@both
def test_upsert_with_nulls_and_repeated_new_keys(spark, on):
    s = source(spark, (1, "x", 1), (2, "y", 2), (2, "z", 3), (None, "n", 4))
    out = merge(table(spark), s, on).when_matched_update_all().when_not_matched_insert_all().to_df()
    assert rows(out) == [(None, "N", 0), (None, "n", 4), (1, "x", 1), (2, "y", 2), (2, "z", 3), (3, "C", 30)]
    assert out.schema == table(spark).schema


@both
def test_several_sources_for_one_row_raise(spark, on):
    s = source(spark, (1, "x", 1), (1, "y", 2))
    builder = merge(table(spark), s, on)
    for merged in (builder.when_matched_update_all(), builder.when_matched_delete("s.n = 1"),
                   builder.when_matched_update(set={"n": "s.n"}).when_not_matched_insert_all()):
        with pytest.raises(PySparkException, match="MERGE_CARDINALITY_VIOLATION"):
            merged.to_df().collect()
        with pytest.raises(PySparkException, match="MERGE_CARDINALITY_VIOLATION"):
            merged.to_df().count()


@both
def test_several_sources_are_fine_for_a_plain_delete(spark, on):
    s = source(spark, (1, "x", 1), (1, "y", 2), (None, "n", 0))
    assert rows(merge(table(spark), s, on).when_matched_delete().to_df()) == [(None, "N", 0), (3, "C", 30)]


@both
def test_insert_only_leaves_matches_alone(spark, on):
    s = source(spark, (1, "x", 1), (1, "y", 2), (2, "z", 5))
    out = merge(table(spark), s, on).when_not_matched_insert_all("s.n > 1").to_df()
    assert rows(out) == [(None, "N", 0), (1, "A", 10), (2, "z", 5), (3, "C", 30)]


@both
def test_first_true_clause_wins_and_null_is_not_true(spark, on):
    s = source(spark, (1, "x", None), (3, "y", 99))
    first_delete = (merge(table(spark), s, on).when_matched_delete("s.n > 50")
                    .when_matched_update_all("s.n is null or s.n > 50"))
    assert rows(first_delete.to_df()) == [(None, "N", 0), (1, "x", None)]
    first_update = merge(table(spark), s, on).when_matched_update_all("s.n > 50").when_matched_delete()
    assert rows(first_update.to_df()) == [(None, "N", 0), (3, "y", 99)]
    none_fires = merge(table(spark), s, on).when_matched_delete("s.n > 500")
    assert rows(none_fires.to_df()) == rows(table(spark))


@both
def test_unlisted_columns(spark, on):
    s = source(spark, (1, "x", 1), (2, "y", 2))
    out = (merge(table(spark), s, on).when_matched_update(set={"v": F.concat("t.v", "s.v")})
           .when_not_matched_insert(values={"k": "s.k"}).to_df())
    assert rows(out) == [(None, "N", 0), (1, "Ax", 10), (2, None, None), (3, "C", 30)]


@both
def test_actions_and_metrics(spark, on):
    s = source(spark, (1, "x", 1), (2, "y", 2), (3, "z", 3))
    builder = (merge(table(spark), s, on).when_matched_delete("s.n = 3").when_matched_update_all()
               .when_not_matched_insert_all())
    assert rows(builder.actions(), "k", ACTION) == [(None, "kept"), (1, "updated"), (2, "inserted"), (3, "deleted")]
    assert builder.metrics().first().asDict() == {
        "rows_inserted": 1, "rows_updated": 1, "rows_deleted": 1, "rows_kept": 1}


def test_composite_keys_with_nulls(spark):
    schema = "a int, b int, v string"
    t = spark.createDataFrame([(1, 1, "A"), (1, None, "B"), (2, 1, "C")], schema)
    s = spark.createDataFrame([(1, 1, "x"), (1, None, "y"), (None, 1, "z"), (2, 2, "w")], schema)
    out = merge(t, s, ["a", "b"]).when_matched_update_all().when_not_matched_insert_all().to_df()
    assert rows(out) == [(None, 1, "z"), (1, None, "B"), (1, None, "y"), (1, 1, "x"), (2, 1, "C"), (2, 2, "w")]


def test_key_types_may_differ(spark):
    t = spark.createDataFrame([(5_000_000_000, "A"), (1, "B")], "k long, v string")
    s = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    out = merge(t, s, ["k"]).when_matched_update_all().when_not_matched_insert_all().to_df()
    assert rows(out) == [(1, "x"), (2, "y"), (5_000_000_000, "A")]


def test_target_may_repeat_keys(spark):
    t = spark.createDataFrame([(1, "A", 1), (1, "B", 2), (2, "C", 3)], SCHEMA)
    s = source(spark, (1, "x", 9))
    assert rows(merge(t, s, KEYED).when_matched_update_all().to_df()) == [(1, "x", 9), (1, "x", 9), (2, "C", 3)]


def test_range_predicate(spark):
    s = spark.createDataFrame([(5, 15, "low"), (25, 35, "high")], "lo int, hi int, tag string").alias("s")
    out = merge(table(spark), s, "t.n between s.lo and s.hi").when_matched_update(set={"v": "s.tag"}).to_df()
    assert rows(out) == [(None, "N", 0), (1, "low", 10), (3, "high", 30)]


def test_assignment_casts_raise_on_overflow(spark):
    s = spark.createDataFrame([(1, "x", 1 << 40)], "k int, v string, n long")
    with pytest.raises(PySparkException, match="OVERFLOW"):
        merge(table(spark), s, KEYED).when_matched_update_all().to_df().collect()


def test_builder_rules(spark):
    t, s = table(spark), source(spark, (1, "x", 1))
    start = merge(t, s, KEYED)
    with pytest.raises(ValueError):
        start.to_df()
    with pytest.raises(ValueError):
        start.when_matched_update_all().when_matched_delete()
    with pytest.raises(ValueError):
        start.when_matched_delete("s.n = 1").when_matched_delete()
    with pytest.raises(ValueError):
        start.when_matched_update_all("s.n = 1").when_matched_update(set={"n": "1"})
    with pytest.raises(ValueError):
        start.when_not_matched_insert_all().when_not_matched_insert(values={"k": "1"})
    with pytest.raises(ValueError):
        start.when_matched_update(set={"nope": "1"})
    with pytest.raises(ValueError):
        start.when_matched_update()
    with pytest.raises(ValueError):
        start.when_not_matched_insert()
    with pytest.raises(ValueError, match="lacks"):
        merge(t, s.drop("n"), KEYED).when_matched_update_all()
    with pytest.raises(TypeError):
        start.when_matched_update(condition=5, set={"n": "1"})
    # An extra source column is not copied.
    wide = merge(t, s.withColumn("extra", F.lit(1)), KEYED).when_matched_update_all()
    assert wide.to_df().columns == t.columns


def test_merge_arguments(spark):
    t, s = table(spark), source(spark, (1, "x", 1))
    for error, args in ((ValueError, (t, None, KEYED)), (ValueError, (t, s, None)), (TypeError, (t, "s", KEYED)),
                        (TypeError, (t, s, 1)), (TypeError, (t, s, [])), (TypeError, (t, s, [1]))):
        with pytest.raises(error):
            merge(*args)
    with pytest.raises(AnalysisException):
        merge(t, s, "t.k = nobody.k").when_matched_delete().to_df()


def test_self_merge(spark):
    t = table(spark)
    out = merge(t, t.filter("k = 1"), KEYED, source_alias="s").when_matched_update(set={"n": "t.n + s.n"}).to_df()
    assert rows(out) == [(None, "N", 0), (1, "A", 20), (3, "C", 30)]


def test_row_changes(spark):
    t = table(spark)
    assert rows(delete_where(t, "n > 15")) == [(None, "N", 0), (1, "A", 10)]
    assert rows(delete_where(t, "k = 1")) == [(None, "N", 0), (3, "C", 30)]  # null is not true
    assert delete_where(t).count() == 0
    swapped = update_where(t, {"k": "n", "n": "k"})
    assert rows(swapped) == [(0, "N", None), (10, "A", 1), (30, "C", 3)]
    assert rows(update_where(t, {"v": F.lit("z")}, F.col("k") == 3), "v") == [("A",), ("N",), ("z",)]
    with pytest.raises(ValueError):
        update_where(t, None)
    with pytest.raises(ValueError):
        update_where(t, {"nope": "1"})


def test_small_source_moves_no_table_row(spark):
    orders = spark.read.parquet("/root/testdata/sf0.1/orders.parquet")
    few = orders.filter("o_orderdate > '2001-07-30'")
    by_key = merge(orders, few, ["o_orderkey"]).when_matched_update_all()
    by_predicate = merge(orders, few.alias("s"), "t.o_orderkey = s.o_orderkey").when_matched_update_all()
    for builder in (by_key, by_predicate):
        text = plan(builder.to_df())
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "CartesianProduct" not in text
        # With inserts the table is still streamed past the source; only rows both share move.
        full = builder.when_not_matched_insert_all().to_df()
        full.write.format("noop").mode("overwrite").save()
        assert re.search(r"BroadcastHashJoin \[o_orderkey#\d+L\], \[o_orderkey#\d+L\], LeftSemi|LeftSemi, BuildRight", plan(full))
