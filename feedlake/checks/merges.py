"""Checks of the merge builder, clause by clause."""

from __future__ import annotations

from pyspark.sql import functions as F

from feedlake.checks.registry import (
    LINE_FEED,
    ORDER_SOURCE,
    ORDER_TARGET,
    applied_sql,
    check,
    line_feed,
    order_source,
    order_target,
    read,
)
from feedlake.operators.merge import merge
from feedlake.plans.apply import apply_changes

_WITH = f"with t as ({ORDER_TARGET}), s as ({ORDER_SOURCE})"
_ROW = "k, st, price, ts_ms"


def _sides(spark, sf_dir):
    return order_target(spark, sf_dir), order_source(spark, sf_dir).alias("s")


def _both(spark, sf_dir, on=("k",)):
    target, source = _sides(spark, sf_dir)
    return merge(target, source, list(on) if isinstance(on, tuple) else on)


_INSERTED = f"select {_ROW} from s where not exists (select 1 from t where t.k = s.k)"
_UNTOUCHED = f"select {_ROW} from t where not exists (select 1 from s where t.k = s.k)"


@check(
    "merge_upsert",
    f"{_WITH} {_UNTOUCHED} union all select {_ROW} from s",
)
def _merge_upsert(spark, sf_dir):
    return _both(spark, sf_dir).when_matched_update_all().when_not_matched_insert_all().to_df()


@check("merge_delete", f"{_WITH} {_UNTOUCHED}")
def _merge_delete(spark, sf_dir):
    return _both(spark, sf_dir).when_matched_delete().to_df()


@check(
    "merge_theta",
    f"""{_WITH}, pairs as (select t.k, s.st, s.price, s.ts_ms from t join s
                           on t.k = s.k and t.price <= 300 * s.cust and s.ts_ms > t.ts_ms)
        select {_ROW} from t where k not in (select k from pairs)
        union all select {_ROW} from pairs
        union all select {_ROW} from s where k not in (select k from pairs)""",
)
def _merge_theta(spark, sf_dir):
    condition = "t.k = s.k and t.price <= 300 * s.cust and s.ts_ms > t.ts_ms"
    return _both(spark, sf_dir, condition).when_matched_update_all().when_not_matched_insert_all().to_df()


@check(
    "merge_unequal_keys",
    f"""{_WITH} select t.k, coalesce(s.st, t.st) as st, coalesce(s.price, t.price) as price, t.ts_ms
        from t left join s on t.k = s.k and s.cust % 2 = 0
        union all select k, st, price, null from s where not (cust % 2 = 0 and k in (select k from t))""",
)
def _merge_unequal_keys(spark, sf_dir):
    """Keys of other names and types on the two sides, and a condition on one side."""
    target, source = _sides(spark, sf_dir)
    named = source.select(F.col("k").cast("decimal(20,0)").alias("order_no"), "st", "price", "cust").alias("s")
    return (
        merge(target, named, "s.order_no = t.k and s.cust % 2 = 0")
        .when_matched_update(set={"st": "s.st", "price": "s.price"})
        .when_not_matched_insert(values={"k": "s.order_no", "st": "s.st", "price": "s.price"})
        .to_df()
    )


# Price bands that do not overlap, one a part; the last is open upwards.
_BANDS = """
select p_partkey as band, p_brand as name, p_partkey * 150.0 as lo,
       case when p_partkey = {last} then 1e15 else p_partkey * 150.0 + 100 end as hi from {parts}"""


@check(
    "merge_band",
    f"""with t as ({ORDER_TARGET}), s as ({_BANDS.format(last="(select max(p_partkey) from part)", parts="part")})
        select t.k, coalesce(s.name, t.st) as st, t.price, t.ts_ms from t left join s on t.price >= s.lo and t.price < s.hi
        union all select -band, name, lo, null from s
        where not exists (select 1 from t where t.price >= s.lo and t.price < s.hi)""",
)
def _merge_band(spark, sf_dir):
    """Joined by a range alone; one band is open."""
    parts = read(spark, sf_dir, "part")
    last = parts.agg(F.max("p_partkey")).first()[0]
    bands = spark.sql(_BANDS.format(last=last, parts="{parts}"), parts=parts).alias("s")
    return (
        merge(order_target(spark, sf_dir), bands, "t.price >= s.lo and t.price < s.hi")
        .when_matched_update(set={"st": "s.name"})
        .when_not_matched_insert(values={"k": "-s.band", "st": "s.name", "price": "s.lo"})
        .to_df()
    )


@check(
    "merge_update_set",
    f"""{_WITH} select t.k, case when s.k is null then t.st else 'X' end as st,
                       case when s.k is null then t.price else t.price + s.price end as price, t.ts_ms
        from t left join s on t.k = s.k""",
)
def _merge_update_set(spark, sf_dir):
    return (
        _both(spark, sf_dir)
        .when_matched_update(set={"price": "t.price + s.price", "st": F.lit("X")})
        .to_df()
    )


@check(
    "merge_update_all_if",
    f"""{_WITH} select t.k, case when s.price > 250000 then s.st else t.st end as st,
                       case when s.price > 250000 then s.price else t.price end as price,
                       case when s.price > 250000 then s.ts_ms else t.ts_ms end as ts_ms
        from t left join s on t.k = s.k""",
)
def _merge_update_all_if(spark, sf_dir):
    return _both(spark, sf_dir).when_matched_update_all("s.price > 250000").to_df()


@check(
    "merge_delete_if",
    f"{_WITH} select {_ROW} from t where not (t.st = 'F' and exists (select 1 from s where s.k = t.k))",
)
def _merge_delete_if(spark, sf_dir):
    return _both(spark, sf_dir).when_matched_delete(F.col("t.st") == "F").to_df()


@check(
    "merge_insert_values",
    f"""{_WITH} select {_ROW} from t union all
        select k, null, price * 2, ts_ms from s
        where cust > 100 and not exists (select 1 from t where t.k = s.k)""",
)
def _merge_insert_values(spark, sf_dir):
    return (
        _both(spark, sf_dir)
        .when_not_matched_insert("s.cust > 100", {"k": "s.k", "price": F.col("s.price") * 2, "ts_ms": "s.ts_ms"})
        .to_df()
    )


@check(
    "merge_insert_all_if",
    f"{_WITH} select {_ROW} from t union all ({_INSERTED} and s.price < 200000)",
)
def _merge_insert_all_if(spark, sf_dir):
    return _both(spark, sf_dir).when_not_matched_insert_all("s.price < 200000").to_df()


@check(
    "merge_clause_order",
    f"""{_WITH}, pairs as (select t.*, s.st as s_st, s.price as s_price, s.ts_ms as s_ts_ms
                           from t join s on t.k = s.k)
        select 'delete first' as variant, k, s_st as st, s_price as price, s_ts_ms as ts_ms
        from pairs where not s_price > 300000
        union all select 'delete first', * from ({_UNTOUCHED})
        union all select 'delete first', * from ({_INSERTED} and s.cust > 100)
        union all select 'update first', k, s_st, s_price, s_ts_ms from pairs where s_price > 150000
        union all select 'update first', {_ROW} from pairs where not s_price > 150000 and st <> 'F'
        union all select 'update first', * from ({_UNTOUCHED})""",
)
def _merge_clause_order(spark, sf_dir):
    delete_first = (
        _both(spark, sf_dir)
        .when_matched_delete("s.price > 300000")
        .when_matched_update_all()
        .when_not_matched_insert_all("s.cust > 100")
    )
    # Rows that satisfy both conditions are updated; rows that satisfy none stay.
    update_first = (
        _both(spark, sf_dir).when_matched_update_all("s.price > 150000").when_matched_delete("t.st = 'F'")
    )
    variant = F.lit("delete first").alias("variant")
    return (
        delete_first.to_df()
        .select(variant, "*")
        .unionByName(update_first.to_df().select(F.lit("update first").alias("variant"), "*"))
    )


# Stored lines before the batch: those that were returned or accepted.
_LINE_TARGET = """
select k1, k2, price - 1 as price, ts_ms - 1 as ts_ms from {feed} where op = 'd'"""


@check(
    "merge_composite_key",
    applied_sql(
        LINE_FEED, _LINE_TARGET.format(feed=f"({LINE_FEED})"), ("k1", "k2"), "k1, k2, price, ts_ms"
    ),
)
def _merge_composite_key(spark, sf_dir):
    feed = line_feed(spark, sf_dir)
    target = spark.sql(_LINE_TARGET, feed=feed)
    return apply_changes(target, feed, ["k1", "k2"])


@check(
    "alias_predicate",
    f"""{_WITH} select t.k, coalesce(s.st, t.st) as st, case when s.k is null then t.price else s.price - t.price end as price,
                       t.ts_ms from t left join s on s.k = t.k and t.st <> 'F'""",
)
def _alias_predicate(spark, sf_dir):
    # Caller-chosen names; one value as SQL text, the condition as a Column.
    target, source = order_target(spark, sf_dir), order_source(spark, sf_dir).alias("incoming")
    condition = (F.col("stored.k") == F.col("incoming.k")) & (F.col("stored.st") != "F")
    return (
        merge(target, source, condition, target_alias="stored")
        .when_matched_update(set={"price": "incoming.price - stored.price", "st": F.col("incoming.st")})
        .to_df()
    )
