"""Checks of newest-per-key, diffs, row changes and time columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.checks.registry import (
    EVENT_FEED,
    LINE_FEED,
    ORDER_FEED,
    ORDER_TARGET,
    check,
    event_feed,
    line_feed,
    newest_sql,
    order_feed,
    order_target,
    read,
)
from feedlake.functions.timecols import normalize_timestamps
from feedlake.operators.diff import snapshot_diff
from feedlake.operators.flatten import flatten
from feedlake.operators.latest import latest_per_key, with_group_max
from feedlake.operators.rowchanges import change_metrics, delete_actions, delete_where, update_where
from feedlake.plans.apply import apply_changes


@check("window_max", f"select *, max(ts_ms) over (partition by k) as ts_ms_max from ({EVENT_FEED})")
def _window_max(spark, sf_dir):
    return with_group_max(event_feed(spark, sf_dir), ["k"])


@check("latest_per_key", newest_sql(f"({ORDER_FEED})"))
def _latest_per_key(spark, sf_dir):
    return latest_per_key(order_feed(spark, sf_dir), ["k"])


@check("latest_per_key_events", newest_sql(f"({EVENT_FEED})"))
def _latest_per_key_events(spark, sf_dir):
    return latest_per_key(event_feed(spark, sf_dir), ["k"])


@check("latest_per_composite_key", newest_sql(f"({LINE_FEED})", "k1, k2"))
def _latest_per_composite_key(spark, sf_dir):
    return latest_per_key(line_feed(spark, sf_dir), ["k1", "k2"])


@check(
    "latest_per_key_single",
    f"""select * exclude (n) from (select *, row_number() over (
            partition by k order by ts_ms desc, op desc, st desc) as n from ({ORDER_FEED})) where n = 1""",
)
def _latest_per_key_single(spark, sf_dir):
    return latest_per_key(order_feed(spark, sf_dir), ["k"], tie_break=["op", "st"])


# Customers of one segment leave, another segment is changed, one nation is added again.
_NEW_CUSTOMERS = """
select c_custkey, c_name, c_nationkey,
       case when c_mktsegment = 'MACHINERY' then c_acctbal + 1 else c_acctbal end as c_acctbal, c_mktsegment
from {customer} where c_mktsegment <> 'BUILDING'
union all select -c_custkey - 1, c_name, c_nationkey, c_acctbal, c_mktsegment
from {customer} where c_nationkey = 3"""

_CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _customers(spark, sf_dir):
    old = read(spark, sf_dir, "customer").select(*_CUSTOMER_COLUMNS)
    return old, spark.sql(_NEW_CUSTOMERS, customer=old)


@check(
    "snapshot_diff",
    f"""with fresh as ({_NEW_CUSTOMERS.format(customer="customer")})
        select coalesce(n.c_custkey, o.c_custkey) as c_custkey, o.c_acctbal as before_acctbal,
               n.c_acctbal as after_acctbal, n.c_name as after_name, o.c_name as before_name,
               case when o.c_custkey is null then 'c' when n.c_custkey is null then 'd' else 'u' end as op,
               1700000000000 as ts_ms
        from customer o full outer join fresh n on o.c_custkey = n.c_custkey
        where o.c_custkey is null or n.c_custkey is null or o.c_acctbal <> n.c_acctbal""",
)
def _snapshot_diff(spark, sf_dir):
    old, new = _customers(spark, sf_dir)
    return snapshot_diff(old, new, ["c_custkey"], 1700000000000).select(
        F.coalesce("after.c_custkey", "before.c_custkey").alias("c_custkey"),
        F.col("before.c_acctbal").alias("before_acctbal"),
        F.col("after.c_acctbal").alias("after_acctbal"),
        F.col("after.c_name").alias("after_name"),
        F.col("before.c_name").alias("before_name"),
        "op",
        "ts_ms",
    )


@check("diff_then_apply", _NEW_CUSTOMERS.format(customer="customer"))
def _diff_then_apply(spark, sf_dir):
    old, new = _customers(spark, sf_dir)
    feed = flatten(snapshot_diff(old, new, ["c_custkey"], 1700000000000))
    stored = old.withColumn("ts_ms", F.lit(0).cast("long"))
    return apply_changes(stored, feed, ["c_custkey"]).drop("ts_ms")


@check("delete_where", f"select * from ({ORDER_TARGET}) where not (st = 'F' and price > 250000)")
def _delete_where(spark, sf_dir):
    return delete_where(order_target(spark, sf_dir), "st = 'F' and price > 250000")


@check(
    "delete_all",
    f"""select 'rows_left' as what, 0 as n
        union all select 'rows_deleted', count(*) from ({ORDER_TARGET})""",
)
def _delete_all(spark, sf_dir):
    target = order_target(spark, sf_dir)
    left = delete_where(target).agg(F.count("*").alias("n"))
    gone = change_metrics(delete_actions(target)).select(F.col("rows_deleted").alias("n"))
    return left.select(F.lit("rows_left").alias("what"), "n").unionByName(
        gone.select(F.lit("rows_deleted").alias("what"), "n")
    )


@check(
    "update_where",
    f"""select k, case when st = 'O' then 'open' else st end as st,
               case when st = 'O' then price + k else price end as price, ts_ms from ({ORDER_TARGET})""",
)
def _update_where(spark, sf_dir):
    return update_where(order_target(spark, sf_dir), {"st": F.lit("open"), "price": "price + k"}, "st = 'O'")


@check(
    "update_all",
    f"select k, st || '-' || st as st, price * 2 as price, ts_ms + 1 as ts_ms from ({ORDER_TARGET})",
)
def _update_all(spark, sf_dir):
    return update_where(
        order_target(spark, sf_dir),
        {"st": "st || '-' || st", "price": F.col("price") * 2, "ts_ms": "ts_ms + 1"},
    )


@check(
    "normalize_timestamps",
    f"""select k, event_id, strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g') as at,
               strftime(make_timestamp(ts_ms * 1000), '%Y-%m') as month from ({EVENT_FEED})""",
)
def _normalize_timestamps(spark, sf_dir):
    typed = normalize_timestamps(event_feed(spark, sf_dir), ["ts_ms"], ref_time_column="ts_ms", partition="month")
    return typed.select("k", "event_id", F.date_format("ts_ms", "yyyy-MM-dd HH:mm:ss.SSS").alias("at"), "month")
