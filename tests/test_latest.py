import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from feedlake.operators.latest import first_per_key, latest_per_key, with_group_max
from fixture_feeds import F1, F2, F3, TIES_NEWEST, feed, figures, ties


def test_ties_and_nulls(spark):
    assert rows(latest_per_key(ties(spark), ["k"])) == TIES_NEWEST


def test_tie_break_keeps_one(spark):
    one = latest_per_key(ties(spark), ["k"], tie_break=["op", F.col("v").asc()])
    assert rows(one) == [(None, "g", "u", 3), (1, "a", "u", 5), (2, "c", "c", 7), (4, "f", "d", 9), (5, "i", "c", 1),
                         (6, "j", "d", 4)]


def test_tie_break_is_settled_by_the_other_columns(spark):
    data = [(1, 5, f"v{i}", {"a": i}) for i in range(40)]
    df = spark.createDataFrame(data, "k int, ts_ms long, v string, m map<string,int>")
    picks = {latest_per_key(df.repartition(n), ["k"], tie_break=[]).first()["v"] for n in (1, 3, 7)}
    assert picks == {"v9"}


def test_idempotent(spark):
    once = latest_per_key(ties(spark), ["k"])
    assert rows(latest_per_key(once, ["k"])) == rows(once)


@pytest.mark.parametrize(
    "sf, sql, table, keys, expected",
    [
        ("sf0.001", F1, "orders", ["k"], (1640, 1463540832978000)),
        ("sf0.01", F1, "orders", ["k"], (16388, 14636482195357000)),
        ("sf0.001", F2, "events", ["k"], (15, 25599360790545)),
        ("sf0.01", F2, "events", ["k"], (150, 255993391463397)),
        ("sf0.001", F3, "lineitem", ["k1", "k2"], (4599, 4172172626013000)),
        ("sf0.01", F3, "lineitem", ["k1", "k2"], (45832, 41539544603012000)),
    ],
)
def test_known_figures(spark, sf, sql, table, keys, expected):
    assert figures(latest_per_key(feed(spark, sf, sql, table), keys)) == expected


def test_group_max(spark):
    out = with_group_max(ties(spark), ["k"])
    assert rows(out, "k", "v", "ts_ms_max")[:2] == [(None, "g", 3), (None, "h", 3)]
    assert out.count() == 11
    assert rows(out.filter("v = 'e'"), "ts_ms_max") == [(None,)]


def test_first_per_key_flags_repeats(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d"), (None, "e")], "k int, v string")
    assert rows(first_per_key(df, ["k"], [F.col("v").asc()], flag="more")) == [
        (None, "e", False), (1, "a", True), (2, "d", False)]


def test_plans_reduce_before_the_exchange(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    single = plan(latest_per_key(orders, ["o_custkey"], "o_orderdate", tie_break=["o_orderkey"]))
    assert single.count("Exchange") == 1 and single.count("WindowGroupLimit") == 2
    tied = plan(latest_per_key(orders, ["o_custkey"], "o_orderdate"))
    # The narrow aggregate reads two columns and is combined before it moves; no window.
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in tied
    assert "partial_max" in tied and "Window" not in tied
