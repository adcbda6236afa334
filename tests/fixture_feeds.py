"""Change feeds with known figures, and the tie and null fixture."""

from pyspark.sql import functions as F

MS = "unix_millis(cast({} as timestamp))"

F1 = f"""
with base as (select o_orderkey as k, o_orderstatus as st, o_totalprice as price, {MS.format("o_orderdate")} as ms
              from {{source}})
select k, st, price, 'r' as op, ms as ts_ms from base
union all select k, 'U', price+1, 'u', ms+1000 from base where k%5=0
union all select k, st, price, 'd', ms+2000 from base where k%7=0
union all select k, st, price, 'd', ms+1000 from base where k%11=0
union all select k+100000000, 'C', price, 'c', ms+1500 from base where k%13=0"""

F2 = f"""
select user_id as k, event_id, value,
       case event_type when 'signup' then 'c' when 'purchase' then 'r' when 'error' then 'd' else 'u' end as op,
       {MS.format("ts")} as ts_ms from {{source}}"""

F3 = f"""
with base as (select l_orderkey as k1, l_linenumber as k2, min(l_extendedprice) as price,
                     max({MS.format("l_shipdate")}) as ms
              from {{source}} group by l_orderkey, l_linenumber)
select k1, k2, price, 'r' as op, ms as ts_ms from base
union all select k1, k2, price+1, 'u', ms+1000 from base where (k1+k2)%4=0
union all select k1, k2, price, 'd', ms+2000 from base where (k1+k2)%9=0"""


def feed(spark, sf, sql, table):
    return spark.sql(sql, source=spark.read.parquet(f"/root/testdata/{sf}/{table}.parquet"))


def f1_target(spark, sf):
    return feed(spark, sf, F1, "orders").filter("op = 'r' and k % 3 <> 0").select("k", "st", "price", "ts_ms")


TIES = [
    (1, "a", "u", 5), (1, "b", "d", 5), (2, "c", "c", 7), (2, "d", "u", 6), (3, "e", "u", None),
    (4, "f", "d", 9), (None, "g", "u", 3), (None, "h", "d", 3), (5, "i", "c", 1), (6, "j", "d", 4),
    (6, "k", "c", 4),
]
TIES_NEWEST = [
    (None, "g", "u", 3), (None, "h", "d", 3), (1, "a", "u", 5), (1, "b", "d", 5), (2, "c", "c", 7),
    (4, "f", "d", 9), (5, "i", "c", 1), (6, "j", "d", 4), (6, "k", "c", 4),
]
TIES_TARGET = [(1, "A", 0), (2, "B", 0), (3, "C", 0), (4, "D", 0)]
TIES_APPLIED = [(None, "g", 3), (2, "c", 7), (3, "C", 0), (5, "i", 1)]


def ties(spark):
    return spark.createDataFrame(TIES, "k int, v string, op string, ts_ms long")


def ties_target(spark):
    return spark.createDataFrame(TIES_TARGET, "k int, v string, ts_ms long")


def figures(df):
    return tuple(df.agg(F.count("*"), F.sum("ts_ms")).first())
