import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from conftest import plan, rows
from feedlake import checks
from feedlake.functions.expressions import as_assignments, as_condition
from feedlake.functions.topics import catalog_name, table_alias, topic_path
from feedlake.operators.flatten import after_images, before_images, deletes, flatten, to_envelope, upserts
from feedlake.sources.feeds import envelope, read_feed, write_raw

ROW = StructType([StructField("k", IntegerType()), StructField("v", StringType())])


def test_condition_and_assignment_types(spark):
    assert as_condition(None) is None
    as_condition("a = 1"), as_condition(F.col("a") == 1)
    with pytest.raises(TypeError):
        as_condition(1)
    with pytest.raises(ValueError):
        as_assignments(None)
    with pytest.raises(TypeError):
        as_assignments([("a", "1")])
    with pytest.raises(TypeError):
        as_assignments({1: "a"})
    with pytest.raises(TypeError):
        as_assignments({"a": 1})


def test_unknown_and_null_ops_are_left_out(spark):
    feed = spark.createDataFrame([(1, "r"), (2, "c"), (3, "u"), (4, "d"), (5, "x"), (6, None)], "k int, op string")
    assert rows(upserts(feed), "k") == [(1,), (2,), (3,)]
    assert rows(deletes(feed), "k") == [(4,)]


def test_images_and_flatten(spark):
    feed = spark.createDataFrame(
        [((1, "a"), None, "c", 1), ((2, "b"), (2, "old"), "u", 2), (None, (3, "z"), "d", 3), (None, None, "d", 4),
         ((9, "q"), None, None, 5)],
        envelope(ROW),
    )
    assert rows(after_images(feed).filter("ts_ms < 4")) == [(None, None, "d", 3), (1, "a", "c", 1), (2, "b", "u", 2)]
    assert rows(before_images(feed).filter("ts_ms < 4")) == [(None, None, "c", 1), (2, "old", "u", 2), (3, "z", "d", 3)]
    flat = [(None, None, "d", 4), (1, "a", "c", 1), (2, "b", "u", 2), (3, "z", "d", 3)]
    assert rows(flatten(feed)) == flat
    assert rows(flatten(to_envelope(flatten(feed).filter("k is not null")))) == flat[1:]


def test_images_match_by_name_and_may_lack_columns(spark):
    feed = spark.createDataFrame([((1, "a"), None, "c", 1), (None, (2,), "d", 2)],
                                 "after struct<k int, v string>, before struct<k int>, op string, ts_ms long")
    assert rows(flatten(feed)) == [(1, "a", "c", 1), (2, None, "d", 2)]
    feed = spark.createDataFrame([(None, ("x", 2), "d", 2)],
                                 "after struct<k int, v string>, before struct<v string, k int>, op string, ts_ms long")
    assert rows(flatten(feed)) == [(2, "x", "d", 2)]


def test_row_columns_named_like_control_columns_raise(spark):
    feed = spark.createDataFrame([], "after struct<k int, op string>, before struct<k int, op string>, op string, ts_ms long")
    for operator in (flatten, after_images, before_images):
        with pytest.raises(ValueError):
            operator(feed)


def test_flatten_reads_only_the_fields_in_use(spark, tmp_path):
    path = str(tmp_path / "feed")
    write_raw(spark.createDataFrame([((1, "a"), None, "c", 1)], envelope(ROW)), path)
    text = plan(flatten(read_feed(spark, path, ROW)).select("k", "ts_ms"))
    assert "ReadSchema: struct<after:struct<k:int>,before:struct<k:int>,op:string,ts_ms:bigint>" in text
    assert "PushedFilters: [In(op, [c,d,r,u])]" in text


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_feed_formats(spark, tmp_path, fmt):
    feed = spark.createDataFrame([((1, "a"), None, "c", 1), (None, (1, "a"), "d", 2)], envelope(ROW))
    path = str(tmp_path / fmt)
    feed.write.format(fmt).save(path)
    assert rows(flatten(read_feed(spark, path, ROW, fmt))) == [(1, "a", "c", 1), (1, "a", "d", 2)]
    assert rows(flatten(read_feed(spark, path, fmt=fmt)).select("k", "v", "op", "ts_ms")) == rows(flatten(feed))


def test_empty_feeds(spark, tmp_path):
    missing = str(tmp_path / "missing")
    assert read_feed(spark, missing) is None
    assert read_feed(spark, missing, ROW).count() == 0
    (tmp_path / "hollow").mkdir()
    assert read_feed(spark, str(tmp_path / "hollow")) is None
    assert read_feed(spark, str(tmp_path / "hollow"), ROW).count() == 0
    with pytest.raises(Exception, match="DATA_SOURCE_NOT_FOUND"):
        read_feed(spark, missing, fmt="no_such_format")


def test_raw_files_are_bounded(spark, tmp_path):
    path = str(tmp_path / "raw")
    write_raw(spark.range(10).coalesce(1), path, rows_per_file=3)
    sizes = spark.read.parquet(path).groupBy(F.input_file_name()).count()
    assert sorted(r["count"] for r in sizes.collect()) == [1, 3, 3, 3]
    with pytest.raises(ValueError):
        write_raw(spark.range(1), path, rows_per_file=0)


def test_bounded_file_sink_sums_beyond_a_long(spark, tmp_path):
    orders = spark.range(2500).selectExpr(
        "id as o_orderkey", "'F' as o_orderstatus", "1.5D as o_totalprice", "timestamp_millis(9000000000000000) as o_orderdate", "'1-URGENT' as o_orderpriority"
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    assert rows(checks.queries()["bounded_file_sink"](spark, str(tmp_path)), "n_rows", "sum_ts_ms", "files_over_cap") == [(2500, 2500 * 9 * 10**15, 0)]


def test_topic_names():
    assert topic_path("raw/", "shop.public.items") == "raw/public/shop.public.items"
    assert table_alias("shop.public.items") == "items"
    assert catalog_name("shop.public.items") == "shop_public_items"
    for bad in ("items", "a.b", "a..c", "a.b.c.d"):
        with pytest.raises(ValueError):
            topic_path("raw", bad)
