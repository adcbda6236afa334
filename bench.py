"""Headline timings. Prints one JSON line.

    BENCH_SF_DIR  folder of the test tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local cores (default: all)
    BENCH_RUNS    timed runs per query; the median counts (default 3, after one warm-up)

Feeds and stored tables are written first and not timed, so a query is read, work, write.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlake import (
    LakeTable,
    Layout,
    TableConfig,
    apply_changes,
    latest_per_key,
    merge,
    publish,
    snapshot_diff,
    stream_apply,
    with_group_max,
)
from feedlake.checks import registry
from feedlake.checks.images import ORDER_ROW
from feedlake.operators.flatten import flatten, to_envelope
from feedlake.plans.apply import apply_batch

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "*")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def session(folder: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("feedlake-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    folder = tempfile.mkdtemp(prefix="feedlake-bench-")
    spark = session(folder)
    stored = iter(range(10**6))

    def keep(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    orders = keep(registry.order_feed(spark, SF_DIR), "orders")
    lines = keep(registry.line_feed(spark, SF_DIR), "lines")
    events = keep(registry.event_feed(spark, SF_DIR), "events")
    envelope = keep(to_envelope(orders), "envelope")
    target = keep(registry.order_target(spark, SF_DIR), "target")
    source = keep(registry.order_source(spark, SF_DIR), "source")
    # The newest 1 % and 10 % of the changes, by time.
    cuts = orders.select(F.percentile("ts_ms", F.array(F.lit(0.99), F.lit(0.90)))).first()[0]
    batches = {
        "1pct": keep(orders.filter(F.col("ts_ms") >= cuts[0]), "batch_1pct"),
        "10pct": keep(orders.filter(F.col("ts_ms") >= cuts[1]), "batch_10pct"),
        "100pct": orders,
    }
    # Changes of the keys given out last, as in a table that mostly grows.
    top = target.agg(F.max("k")).first()[0]
    local = keep(orders.filter(F.col("k") > top * 0.95), "batch_local")
    spark.sql(f"create database bench location '{folder}/bench'")
    after = keep(apply_changes(target, orders, ["k"], tie_break=["st"]), "after")

    def table(layout: Layout = Layout()) -> LakeTable:
        root = f"{folder}/table_{next(stored)}"
        return LakeTable.at(spark, root, layout)

    plain, bucketed = table(), table(Layout(("k",), buckets=8, database="bench"))
    sliced = table(Layout(("k",), slices="k div 10000"))
    for t in (plain, bucketed, sliced):
        t.create(target)

    def batch_on(t: LakeTable, batch: DataFrame = orders):
        apply_batch(t, batch, ["k"], tie_break=["st"])

    def publish_replace():
        publish(after, "bench.orders", keys=["k"], buckets=8)

    def stream():
        base = f"{folder}/stream_{next(stored)}"
        config = TableConfig("sales.public.orders", ["k"], tie_break=["st"], row_schema=ORDER_ROW)
        envelope.repartition(10).write.parquet(config.path(f"{base}/raw"))
        start = time.perf_counter()
        stream_apply(spark, config, f"{base}/raw", f"{base}/staged", f"{base}/ckpt", max_files_per_batch=2)
        return time.perf_counter() - start

    queries = {
        "flatten": lambda: run(flatten(envelope)),
        "latest_per_key_orders": lambda: run(latest_per_key(orders, ["k"])),
        "latest_per_key_lines": lambda: run(latest_per_key(lines, ["k1", "k2"])),
        "latest_per_key_events": lambda: run(latest_per_key(events, ["k"])),
        "latest_per_key_single": lambda: run(latest_per_key(lines, ["k1", "k2"], tie_break=["op"])),
        "window_max": lambda: run(with_group_max(events, ["k"])),
        **{
            f"apply_changes_{name}": (lambda b=b: run(apply_changes(target, b, ["k"])))
            for name, b in batches.items()
        },
        "apply_changes_tie_break": lambda: run(apply_changes(target, orders, ["k"], tie_break=["st"])),
        "merge_upsert": lambda: run(
            merge(target, source, ["k"]).when_matched_update_all().when_not_matched_insert_all().to_df()
        ),
        "merge_delete": lambda: run(merge(target, source, ["k"]).when_matched_delete().to_df()),
        "snapshot_diff": lambda: run(snapshot_diff(target, after, ["k"], 1)),
        "apply_batch_plain": lambda: batch_on(plain),
        "apply_batch_bucketed": lambda: batch_on(bucketed),
        "apply_batch_sliced": lambda: batch_on(sliced, local),
        "publish_replace": publish_replace,
        "stream_apply_5_batches": stream,
    }
    seconds = {}
    for name, query in queries.items():
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            inner = query()
            times.append(inner if inner is not None else time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds over headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
