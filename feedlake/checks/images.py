"""Checks of feed reading, filtering and flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.checks.registry import ORDER_FEED, check, order_feed, workspace
from feedlake.functions.topics import route, topic_path
from feedlake.operators.flatten import (
    after_images,
    before_images,
    deletes,
    drop_control,
    flatten,
    to_envelope,
    upserts,
)
from feedlake.operators.latest import with_group_max
from feedlake.sources.feeds import read_feed, write_raw
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

ORDER_ROW = StructType(
    [StructField("k", LongType()), StructField("st", StringType()), StructField("price", DoubleType())]
)


def _images_sql(rows: str) -> str:
    return f"""
select case when op <> 'd' then k::varchar end as after_k, case when op <> 'd' then price end as after_price,
       case when op in ('u', 'd') then k::varchar end as before_k, case when op in ('u', 'd') then st end as before_st,
       op, ts_ms
from ({rows})"""


def _images(feed):
    return feed.select(
        F.col("after.k").cast("string").alias("after_k"),
        F.col("after.price").alias("after_price"),
        F.col("before.k").cast("string").alias("before_k"),
        F.col("before.st").alias("before_st"),
        "op",
        "ts_ms",
    )


@check("read_feed", _images_sql(ORDER_FEED))
def _read_feed(spark, sf_dir):
    path = topic_path(workspace(spark), "sales.public.orders")
    write_raw(to_envelope(order_feed(spark, sf_dir)), path)
    return _images(read_feed(spark, path, ORDER_ROW))


@check("read_feed_json", _images_sql(ORDER_FEED))
def _read_feed_json(spark, sf_dir):
    path = topic_path(workspace(spark), "sales.public.orders")
    to_envelope(order_feed(spark, sf_dir)).write.json(path)
    return _images(read_feed(spark, path, ORDER_ROW, fmt="json"))


@check(
    "empty_feed",
    f"select 'sales.public.orders' as topic, count(*) as n_rows from ({ORDER_FEED}) "
    "union all select 'sales.public.order_items', 0",
)
def _empty_feed(spark, sf_dir):
    folder = workspace(spark)
    topics = ["sales.public.orders", "sales.public.order_items"]
    write_raw(to_envelope(order_feed(spark, sf_dir)), topic_path(folder, topics[0]))
    counts = None
    for topic in topics:
        feed = read_feed(spark, topic_path(folder, topic), ORDER_ROW)
        one = feed.agg(F.count("*").alias("n_rows")).select(F.lit(topic).alias("topic"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


ROWS_PER_FILE = 1000


@check(
    "bounded_file_sink",
    f"select count(*) as n_rows, sum(ts_ms)::bigint as sum_ts_ms, 0::bigint as files_over_cap from ({ORDER_FEED})",
)
def _bounded_file_sink(spark, sf_dir):
    path = topic_path(workspace(spark), "sales.public.orders")
    write_raw(to_envelope(order_feed(spark, sf_dir)), path, rows_per_file=ROWS_PER_FILE)
    per_file = (
        read_feed(spark, path, ORDER_ROW)
        .groupBy(F.input_file_name().alias("file"))
        .agg(F.count("*").alias("n"), F.sum(F.col("ts_ms").cast("decimal(20,0)")).alias("ts"))
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"),
        # Milliseconds of some ten million rows exceed a long.
        F.sum("ts").alias("sum_ts_ms"),
        F.count_if(F.col("n") > ROWS_PER_FILE).alias("files_over_cap"),
    )


@check("filter_upserts", f"select * from ({ORDER_FEED}) where op in ('r', 'c', 'u')")
def _filter_upserts(spark, sf_dir):
    return upserts(order_feed(spark, sf_dir))


@check("filter_deletes", f"select * from ({ORDER_FEED}) where op = 'd'")
def _filter_deletes(spark, sf_dir):
    return deletes(order_feed(spark, sf_dir))


@check(
    "flatten_after",
    f"""select case when op <> 'd' then k::varchar end as k, case when op <> 'd' then st end as st,
               case when op <> 'd' then price end as price, op, ts_ms from ({ORDER_FEED})""",
)
def _flatten_after(spark, sf_dir):
    # Null images give null columns; the nullable key is compared as text.
    images = after_images(to_envelope(order_feed(spark, sf_dir)))
    return images.withColumn("k", F.col("k").cast("string"))


@check(
    "flatten_before",
    f"""select case when op in ('u', 'd') then k::varchar end as k, case when op in ('u', 'd') then st end as st,
               case when op in ('u', 'd') then price end as price, op, ts_ms from ({ORDER_FEED})""",
)
def _flatten_before(spark, sf_dir):
    images = before_images(to_envelope(order_feed(spark, sf_dir)))
    return images.withColumn("k", F.col("k").cast("string"))


@check("union_images", ORDER_FEED)
def _union_images(spark, sf_dir):
    # The old image has its columns in another order and is matched by name.
    feed = to_envelope(order_feed(spark, sf_dir))
    shuffled = F.struct(F.col("before.price"), F.col("before.k"), F.col("before.st"))
    feed = feed.withColumn("before", F.when(F.col("before").isNotNull(), shuffled))
    return flatten(feed)


@check(
    "drop_control",
    f"""select k, st, price, ts_ms from
        (select *, max(ts_ms) over (partition by k) as newest from ({ORDER_FEED}))
        where op <> 'd' and ts_ms = newest""",
)
def _drop_control(spark, sf_dir):
    marked = with_group_max(order_feed(spark, sf_dir), ["k"], name="newest")
    return drop_control(upserts(marked).filter("ts_ms = newest"), "newest")


_ROUTED_SQL = """
with feed as (
    select 'sales.public.orders' as topic from orders
    union all select 'sales.public.lines' from lineitem
    union all select 'crm.contacts.customer' from customer
    union all select 'sales.public.part' from part)
select topic, 'raw/topics/' || split_part(topic, '.', 2) || '/' || topic as path,
       split_part(topic, '.', 3) as table_alias, replace(topic, '.', '_') as catalog_name, count(*) as n_rows
from feed where topic in ('sales.public.orders', 'sales.public.lines', 'crm.contacts.customer')
group by all"""


@check("route_topics", _ROUTED_SQL)
def _route_topics(spark, sf_dir):
    tables = {
        "sales.public.orders": "orders",
        "sales.public.lines": "lineitem",
        "crm.contacts.customer": "customer",
        "sales.public.part": "part",
    }
    feed = None
    for topic, table in tables.items():
        one = spark.read.parquet(f"{sf_dir}/{table}.parquet").select(F.lit(topic).alias("topic"))
        feed = one if feed is None else feed.unionByName(one)
    included = ["sales.public.orders", "sales.public.lines", "crm.contacts.customer"]
    routed = route(feed, included, "raw/topics/")
    return routed.groupBy("topic", "path", "table_alias", "catalog_name").agg(F.count("*").alias("n_rows"))
