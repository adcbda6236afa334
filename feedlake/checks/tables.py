"""Checks of stored tables, their history, and publishing."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.checks.registry import (
    ORDER_FEED,
    ORDER_SOURCE,
    ORDER_TARGET,
    applied_sql,
    check,
    database,
    order_feed,
    order_source,
    order_target,
    read,
    workspace,
)
from feedlake.plans.apply import apply_batch, apply_changes
from feedlake.plans.table import LakeTable
from feedlake.sources.publish import BUCKET, publish


@check("publish_create", ORDER_TARGET)
def _publish_create(spark, sf_dir):
    table = f"{database(spark, workspace(spark))}.sales_public_orders"
    publish(order_target(spark, sf_dir), table)
    return spark.table(table)


@check("publish_partitioned", ORDER_TARGET)
def _publish_partitioned(spark, sf_dir):
    table = f"{database(spark, workspace(spark))}.sales_public_orders"
    publish(order_target(spark, sf_dir), table, keys=["k"], buckets=8)
    return spark.table(table).drop(BUCKET)


@check("publish_replace", applied_sql(ORDER_FEED, ORDER_TARGET))
def _publish_replace(spark, sf_dir):
    # Published twice: the second time columns must land by name, not by position.
    table = f"{database(spark, workspace(spark))}.sales_public_orders"
    before = order_target(spark, sf_dir)
    publish(before, table, partition_by=["st"])
    publish(apply_changes(before, order_feed(spark, sf_dir), ["k"]), table)
    return spark.table(table)


@check(
    "bootstrap_parquet",
    "select o_orderkey, o_custkey, o_totalprice, o_orderpriority, o_orderstatus from orders",
)
def _bootstrap_parquet(spark, sf_dir):
    folder = workspace(spark)
    orders = read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus"
    )
    orders.write.partitionBy("o_orderstatus").parquet(f"{folder}/old")
    table = LakeTable.convert(spark, f"{folder}/old", f"{folder}/orders", "o_orderstatus string")
    return table.to_df()


@check("bootstrap_in_place", ORDER_TARGET)
def _bootstrap_in_place(spark, sf_dir):
    """A partitioned Parquet table of others, read through the catalog without a file of it rewritten."""
    folder = workspace(spark)
    order_target(spark, sf_dir).write.partitionBy("st").parquet(f"{folder}/existing")
    table = LakeTable.adopt(spark, f"{folder}/existing", f"{folder}/adopted", "st string")
    name = f"{database(spark, folder)}.orders"
    table.register(name)
    return spark.table(name).select("k", "st", "price", "ts_ms")


@check(
    "table_handle",
    f"""with t as ({ORDER_TARGET}), s as ({ORDER_SOURCE}),
        merged as (select t.k, coalesce(s.st, t.st) as st, coalesce(s.price, t.price) as price,
                          coalesce(s.ts_ms, t.ts_ms) as ts_ms from t left join s on s.k = t.k
                   union all select k, st, price, ts_ms from s where not exists (select 1 from t where t.k = s.k))
        select k, case when price > 400000 then 'high' else st end as st, price, ts_ms
        from merged where not (st = 'F' and price < 100000)""",
)
def _table_handle(spark, sf_dir):
    folder = workspace(spark)
    name = f"{database(spark, folder)}.orders"
    root = f"{folder}/orders"
    assert not LakeTable.is_table(spark, root)
    LakeTable.at(spark, root).create(order_target(spark, sf_dir))
    LakeTable.for_path(spark, root).register(name)
    table = LakeTable.for_name(spark, name).alias("stored")
    (
        table.merge(order_source(spark, sf_dir).alias("fresh"), "stored.k = fresh.k")
        .when_matched_update_all()
        .when_not_matched_insert_all()
        .execute()
    )
    table.delete("st = 'F' and price < 100000")
    table.update("price > 400000", {"st": "'high'"})
    return spark.table(name)


@check(
    "history_topk",
    f"""with t as ({ORDER_TARGET}),
        open as (select * from t where st <> 'P'),
        batch as (select count(*) filter (k in (select k from open)) as hits, count(*) as n from ({ORDER_SOURCE}))
        select 3 as version, 'merge' as operation, n - hits as rows_inserted, hits as rows_updated,
               0 as rows_deleted, (select count(*) from open) - hits as rows_kept from batch
        union all
        select 2, 'delete', 0, 0, (select count(*) from t) - (select count(*) from open), (select count(*) from open)
        union all
        select 1, 'update', 0, count(*) filter (st = 'F'), 0, count(*) filter (st <> 'F') from t""",
)
def _history_topk(spark, sf_dir):
    table = LakeTable.at(spark, f"{workspace(spark)}/orders")
    table.create(order_target(spark, sf_dir))
    table.update("st = 'F'", {"price": "price + 1"})
    table.delete("st = 'P'")
    changes = order_source(spark, sf_dir).select("k", "st", "price", F.lit("u").alias("op"), "ts_ms")
    apply_batch(table, changes, ["k"])
    return table.history(3).select(
        "version", "operation", "rows_inserted", "rows_updated", "rows_deleted", "rows_kept"
    )
