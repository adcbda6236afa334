"""Checks of applying batches, once and over several runs."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import functions as F

from feedlake.checks.images import ORDER_ROW
from feedlake.checks.registry import (
    EVENT_FEED,
    ORDER_FEED,
    ORDER_SOURCE,
    ORDER_TARGET,
    applied_sql,
    check,
    database,
    event_feed,
    newest_sql,
    order_feed,
    order_source,
    order_target,
    workspace,
)
from feedlake.job import run_job
from feedlake.operators.flatten import flatten, to_envelope
from feedlake.operators.merge import merge
from feedlake.plans.apply import apply_batch, apply_changes, effective_changes, first_load, merge_effective
from feedlake.plans.config import TableConfig
from feedlake.plans.run import outcomes_frame, run_tables
from feedlake.plans.table import LakeTable
from feedlake.sources.feeds import write_raw
from feedlake.sources.layout import Layout
from feedlake.sources.storage import exists, set_aside
from feedlake.streaming.stream import stream_apply

ORDERS = TableConfig("sales.public.orders", ["k"], row_schema=ORDER_ROW)


@check("apply_changes", applied_sql(ORDER_FEED, ORDER_TARGET))
def flagship(spark, sf_dir):
    return apply_changes(order_target(spark, sf_dir), to_envelope(order_feed(spark, sf_dir)), ["k"])


@check(
    "apply_changes_tie_break",
    applied_sql(f"select * from ({ORDER_FEED}) where st <> 'C' or k not in (select k from ({ORDER_FEED}) where st = 'D')", ORDER_TARGET),
)
def _apply_changes_tie_break(spark, sf_dir):
    return apply_changes(order_target(spark, sf_dir), order_feed(spark, sf_dir), ["k"], tie_break=["st"])


@check("apply_bucketed", applied_sql(ORDER_FEED, ORDER_TARGET))
def _apply_bucketed(spark, sf_dir):
    folder = workspace(spark)
    table = LakeTable.at(spark, f"{folder}/orders", Layout(("k",), buckets=8, database=database(spark, folder)))
    table.create(order_target(spark, sf_dir))
    apply_batch(table, order_feed(spark, sf_dir), ["k"])
    return table.to_df()


@check("apply_sliced", applied_sql(ORDER_FEED, ORDER_TARGET))
def _apply_sliced(spark, sf_dir):
    table = LakeTable.at(spark, f"{workspace(spark)}/orders", Layout(("k",), slices="k div 1000"))
    table.create(order_target(spark, sf_dir))
    apply_batch(table, order_feed(spark, sf_dir), ["k"])
    return table.to_df()


@check(
    "change_metrics",
    f"""with target as ({ORDER_TARGET}), feed as ({ORDER_FEED}), newest as ({newest_sql("feed")}),
        dead as (select distinct k from newest where op = 'd')
        select (select count(*) from newest where k not in (select k from dead)
                and k not in (select k from target)) as rows_inserted,
               count(*) filter (k in (select k from newest) and k not in (select k from dead)) as rows_updated,
               count(*) filter (k in (select k from dead)) as rows_deleted,
               count(*) filter (k not in (select k from newest)) as rows_kept
        from target""",
)
def _change_metrics(spark, sf_dir):
    effective = effective_changes(order_feed(spark, sf_dir), ["k"])
    return merge_effective(order_target(spark, sf_dir), effective, ["k"]).metrics()


@check(
    "first_load",
    f"select k, st, price, ts_ms from ({newest_sql(f'({ORDER_FEED})')}) where op <> 'd'",
)
def _first_load(spark, sf_dir):
    table = LakeTable.at(spark, f"{workspace(spark)}/orders")
    table.create(first_load(order_feed(spark, sf_dir), ["k"]))
    return table.to_df()


@check("read_snapshot", applied_sql(ORDER_FEED, ORDER_TARGET))
def _read_snapshot(spark, sf_dir):
    table = LakeTable.at(spark, f"{workspace(spark)}/orders")
    table.create(order_target(spark, sf_dir))
    apply_batch(table, to_envelope(order_feed(spark, sf_dir)), ["k"])
    return LakeTable.for_path(spark, table.root).to_df()


# Changes that arrive after newer ones: filled orders come late, open ones in time.
_LATE = """
select k, 'L' as st, price + 7 as price, case when st = 'P' then 'd' else 'u' end as op,
       case when st = 'F' then ts_ms - 1000 else ts_ms + 1000 end as ts_ms from {target}"""


@check(
    "late_guard",
    f"""select k, 'L' as st, price + 7 as price, ts_ms + 1000 as ts_ms from ({ORDER_TARGET}) where st = 'O'
        union all select k, st, price, ts_ms from ({ORDER_TARGET}) where st = 'F'""",
)
def _late_guard(spark, sf_dir):
    target = order_target(spark, sf_dir)
    return apply_changes(target, spark.sql(_LATE, target=target), ["k"], guard="ts_ms")


@check(
    "late_last_batch_wins",
    f"""select k, 'L' as st, price + 7 as price, case when st = 'F' then ts_ms - 1000 else ts_ms + 1000 end as ts_ms
        from ({ORDER_TARGET}) where st <> 'P'""",
)
def _late_last_batch_wins(spark, sf_dir):
    target = order_target(spark, sf_dir)
    return apply_changes(target, spark.sql(_LATE, target=target), ["k"])


@check(
    "late_tombstones",
    f"""with t as ({ORDER_TARGET})
        select k, st, price, ts_ms from t where st = 'O'
        union all select k, 'N', price, ts_ms + 9000 from t where st = 'F' and k % 2 = 0
        union all select k, st, price, ts_ms from t where st = 'P' and k % 3 <> 0
        union all select k, 'N', price, ts_ms + 20 from t where st = 'P' and k % 3 = 0""",
)
def _late_tombstones(spark, sf_dir):
    """Filled orders are deleted; then changes arrive that are older than the deletion, and some newer."""
    table = LakeTable.at(spark, f"{workspace(spark)}/orders")
    target = order_target(spark, sf_dir)
    table.create(target)
    batches = (
        "select k, st, price, 'd' as op, ts_ms + 5000 as ts_ms from {t} where st = 'F'",
        "select k, 'L' as st, price, 'u' as op, ts_ms + 1000 + k % 4001 as ts_ms from {t} where st = 'F'",
        "select k, 'N' as st, price, 'c' as op, ts_ms + 9000 as ts_ms from {t} where st = 'F' and k % 2 = 0",
        "select k, 'N' as st, price, 'u' as op, if(k % 3 = 0, ts_ms + 20, ts_ms - 20) as ts_ms from {t} where st = 'P'",
        "select k, 'X' as st, price, 'u' as op, ts_ms + 5000 as ts_ms from {t} where st = 'F'",
    )
    for sql in batches:
        apply_batch(table, spark.sql(sql, t=target), ["k"], guard="ts_ms", tombstones=10**15)
    return table.to_df()


_FIRST_PART = f"select * from ({ORDER_FEED}) where op = 'r'"
_SECOND_PART = f"select * from ({ORDER_FEED}) where op <> 'r'"
_AFTER_FIRST = f"select k, st, price, ts_ms from ({_FIRST_PART})"


def _land_in_two_runs(spark, sf_dir, run, raw):
    """Full load and changes arrive between two runs of the same job."""
    feed = order_feed(spark, sf_dir)
    for part in ("op = 'r'", "op <> 'r'"):
        write_raw(to_envelope(feed.filter(part)), ORDERS.path(raw))
        result = run()
    return result


@check("stream_apply", applied_sql(_SECOND_PART, _AFTER_FIRST))
def _stream_apply(spark, sf_dir):
    folder = workspace(spark)
    raw = f"{folder}/raw"

    def run():
        return stream_apply(spark, ORDERS, raw, f"{folder}/staged", f"{folder}/checkpoints")

    return _land_in_two_runs(spark, sf_dir, run, raw).to_df()


@check(
    "run_tables",
    f"""with final as ({applied_sql(_SECOND_PART, _AFTER_FIRST)})
        select 'sales.public.orders' as topic, 'replaced' as status, count(*) as n_rows,
               sum(ts_ms)::bigint as sum_ts_ms, 1 as version from final
        union all select 'sales.public.order_items', 'no data', 0, 0, -1
        union all
        select 'sales.public.events', 'replaced', count(*), sum(ts_ms)::bigint, 1
        from ({newest_sql(f"({EVENT_FEED})")}) where op <> 'd'""",
)
def _run_tables(spark, sf_dir):
    folder = workspace(spark)
    raw, name = f"{folder}/raw", database(spark, folder)
    events = TableConfig("sales.public.events", ["k"], big_table=True, publish_buckets=4)
    items = TableConfig("sales.public.order_items", ["k"])

    def run():
        write_raw(to_envelope(event_feed(spark, sf_dir)), events.path(raw))
        return run_tables(
            spark,
            [items, replace(ORDERS, big_table=True, publish_buckets=8), events],
            raw,
            f"{folder}/staged",
            f"{folder}/checkpoints",
            name,
        )

    outcomes = _land_in_two_runs(spark, sf_dir, run, raw)
    content = None
    for config in (ORDERS, events):
        rows = spark.table(f"{name}.{config.catalog_name}").agg(
            F.count("*").alias("n_rows"), F.sum("ts_ms").alias("sum_ts_ms")
        )
        rows = rows.withColumn("topic", F.lit(config.topic))
        content = rows if content is None else content.unionByName(rows)
    report = outcomes_frame(spark, outcomes).drop("error").join(content, "topic", "left_outer")
    return report.fillna({"version": -1, "n_rows": 0, "sum_ts_ms": 0})


@check(
    "stream_reset",
    f"""select k, st, price, ts_ms, case when st <> 'F' then 'new' end as pr from ({ORDER_FEED}) where op = 'r'""",
)
def _stream_reset(spark, sf_dir):
    """Files of which only some have a column; then a new checkpoint in place of the old one,
    whose batches are numbered from 0 again, and more files."""
    folder, feed = workspace(spark), order_feed(spark, sf_dir).filter("op = 'r'")
    config = TableConfig("sales.public.orders", ["k"])
    raw, checkpoints = config.path(f"{folder}/raw"), f"{folder}/checkpoints"
    wide = feed.withColumn("pr", F.lit("new"))

    def run():
        return stream_apply(spark, config, f"{folder}/raw", f"{folder}/staged", checkpoints)

    write_raw(to_envelope(feed.filter("st = 'F'")), raw)
    write_raw(to_envelope(wide.filter("st = 'O'")), raw)
    run()
    set_aside(spark, checkpoints, f"{folder}/former_checkpoints")
    write_raw(to_envelope(wide.filter("st = 'P'")), raw)
    return run().to_df().select("k", "st", "price", "ts_ms", "pr")


@check(
    "job_tables",
    f"""select 'sales.public.orders' as topic, 'created' as status, count(*) as n_rows, sum(k)::bigint as sum_k
        from ({ORDER_FEED}) where op = 'r'
        union all
        select 'sales.public.events', 'created', count(*), sum(k)::bigint
        from ({newest_sql(f"({EVENT_FEED})")}) where op <> 'd'""",
)
def _job_tables(spark, sf_dir):
    """One job over a JSON feed and a Parquet feed, each with places of its own."""
    folder = workspace(spark)
    name = database(spark, folder)
    orders = to_envelope(order_feed(spark, sf_dir).filter("op = 'r'"))
    orders.write.json(ORDERS.path(f"{folder}/raw"))
    events = TableConfig("sales.public.events", ["k"])
    write_raw(to_envelope(event_feed(spark, sf_dir)), events.path(f"{folder}/other"))
    row = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDER_ROW.fields)
    job = {
        "raw": f"{folder}/raw",
        "staged": f"{folder}/staged",
        "checkpoints": f"{folder}/checkpoints",
        "database": name,
        "tables": [
            # JSON leaves out what is null, so the type of the rows is told.
            {"topic_name": "sales.public.orders", "primary_keys": ["k"], "format": "json", "row_schema": row},
            {"topic_name": "sales.public.events", "primary_keys": ["k"], "raw": f"{folder}/other"},
        ],
    }
    outcomes = run_job(spark, json.dumps(job))
    content = None
    for config in (ORDERS, events):
        rows = spark.table(f"{name}.{config.catalog_name}").agg(F.count("*").alias("n_rows"), F.sum("k").alias("sum_k"))
        rows = rows.withColumn("topic", F.lit(config.topic))
        content = rows if content is None else content.unionByName(rows)
    return outcomes_frame(spark, outcomes).select("topic", "status").join(content, "topic")


_NULL_KEYS = "select case when k % 7 = 0 then null else k end as k, st, price, ts_ms from {rows}"


@check(
    "merge_null_keys",
    f"""with t as ({_NULL_KEYS.format(rows=f"({ORDER_TARGET})")}), s as ({_NULL_KEYS.format(rows=f"({ORDER_SOURCE})")})
        select t.k, coalesce(s.st, t.st) as st, coalesce(s.price, t.price) as price, coalesce(s.ts_ms, t.ts_ms) as ts_ms
        from t left join s on s.k = t.k
        union all select k, st, price, ts_ms from s where k is null or not exists (select 1 from t where t.k = s.k)""",
)
def _merge_null_keys(spark, sf_dir):
    """Rows without a key match nothing: those of the table stay, those of the source are inserted."""
    target = spark.sql(_NULL_KEYS, rows=order_target(spark, sf_dir))
    source = spark.sql(_NULL_KEYS, rows=order_source(spark, sf_dir))
    return merge(target, source, ["k"]).when_matched_update_all().when_not_matched_insert_all().to_df()


@check("stream_archive", f"select k, st, price, op, ts_ms from ({ORDER_FEED})")
def _stream_archive(spark, sf_dir):
    """What is left of the feed and what is archived make up the feed."""
    folder, feed = workspace(spark), to_envelope(order_feed(spark, sf_dir))
    raw, archive = f"{folder}/raw", f"{folder}/archive"
    for part in ("op = 'r'", "op <> 'r'"):
        write_raw(feed.filter(part), ORDERS.path(raw))
        stream_apply(spark, ORDERS, raw, f"{folder}/staged", f"{folder}/checkpoints", archive)
    places = [p for p in (raw, archive) if exists(spark, p)]
    everything = spark.read.schema(feed.schema).option("recursiveFileLookup", True).parquet(*places)
    return flatten(everything)
