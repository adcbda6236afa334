"""Name -> (query, SQL), and the inputs the checks share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that gives the same rows."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Epoch milliseconds are UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return query(spark, sf_dir)

        _queries[name] = run
        if sql is not None:
            _sql[name] = sql
        return query

    return register


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def workspace(spark: SparkSession) -> str:
    """A fresh folder in the shared folder the cluster names, or else in the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/feedlake-{uuid.uuid4().hex}"


def database(spark: SparkSession, folder: str) -> str:
    """A fresh catalog database under ``folder``."""
    name = f"feedlake_{uuid.uuid4().hex}"
    spark.sql(f"create database {name} location '{folder}/{name}'")
    return name


# -- shared inputs: the same SQL text for Spark and for the comparison engine --------------


def _spark_ms(column: str) -> str:
    return f"unix_millis(cast({column} as timestamp))"


def _sql_ms(column: str) -> str:
    return f"(epoch_us({column}) // 1000)"


def _order_feed(ms: Callable[[str], str], orders: str) -> str:
    """Changes of orders: updates tied with deletes, later deletes, new keys, tied inserts."""
    return f"""
with base as (select o_orderkey as k, o_orderstatus as st, o_totalprice as price,
                     o_orderpriority as pr, {ms("o_orderdate")} as ms from {orders})
select k, st, price, 'r' as op, ms as ts_ms from base
union all select k, 'U', price + 1, 'u', ms + 1000 from base where st = 'O'
union all select k, st, price, 'd', ms + 2000 from base where pr = '5-LOW'
union all select k, st, price, 'd', ms + 1000 from base where pr = '4-NOT SPECIFIED'
union all select -k - 1, 'C', price, 'c', ms + 1500 from base where st = 'P'
union all select -k - 1, 'D', price, 'c', ms + 1500 from base where st = 'P' and pr = '1-URGENT'"""


def _order_target(ms: Callable[[str], str], orders: str) -> str:
    """Stored orders before the batch; urgent ones have not arrived yet."""
    return f"""
select o_orderkey as k, o_orderstatus as st, o_totalprice as price, {ms("o_orderdate")} as ts_ms
from {orders} where o_orderpriority <> '1-URGENT'"""


def _order_source(ms: Callable[[str], str], orders: str) -> str:
    """One source row per key: urgent keys are new to the target, the others are stored."""
    return f"""
select o_orderkey as k, 'S' as st, o_totalprice + 10 as price, {ms("o_orderdate")} + 500 as ts_ms,
       o_custkey as cust, o_orderpriority as pr
from {orders} where o_orderpriority in ('1-URGENT', '3-MEDIUM', '5-LOW')"""


def _event_feed(ms: Callable[[str], str], events: str) -> str:
    """An event log read as changes of its users: few keys, many changes each."""
    return f"""
select user_id as k, event_id, value,
       case event_type when 'signup' then 'c' when 'purchase' then 'r' when 'error' then 'd' else 'u' end as op,
       {ms("ts")} as ts_ms
from {events}"""


def _line_feed(ms: Callable[[str], str], lineitem: str) -> str:
    """Changes under a composite key."""
    return f"""
with base as (select l_orderkey as k1, l_linenumber as k2, min(l_extendedprice) as price,
                     max(l_returnflag) as flag, max(l_linestatus) as status, max({ms("l_shipdate")}) as ms
              from {lineitem} group by l_orderkey, l_linenumber)
select k1, k2, price, 'r' as op, ms as ts_ms from base
union all select k1, k2, price + 1, 'u', ms + 1000 from base where status = 'O'
union all select k1, k2, price, 'd', ms + 2000 from base where flag = 'A'"""


ORDER_FEED = _order_feed(_sql_ms, "orders")
ORDER_TARGET = _order_target(_sql_ms, "orders")
ORDER_SOURCE = _order_source(_sql_ms, "orders")
EVENT_FEED = _event_feed(_sql_ms, "events")
LINE_FEED = _line_feed(_sql_ms, "lineitem")


def _spark_sql(build, table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.sql(build(_spark_ms, "{source}"), source=read(spark, sf_dir, table))

    return run


order_feed = _spark_sql(_order_feed, "orders")
order_target = _spark_sql(_order_target, "orders")
order_source = _spark_sql(_order_source, "orders")
event_feed = _spark_sql(_event_feed, "events")
line_feed = _spark_sql(_line_feed, "lineitem")


def newest_sql(feed: str, keys: str = "k") -> str:
    """SQL for the newest changes per key of the relation ``feed``."""
    return f"""
select * exclude (m) from (select *, max(ts_ms) over (partition by {keys}) as m from {feed})
where ts_ms = m"""


def applied_sql(feed: str, target: str, keys: tuple[str, ...] = ("k",), row: str = "k, st, price, ts_ms") -> str:
    """SQL for a batch applied to a target: upserts first, then deletes. Both are queries."""
    ks = ", ".join(keys)
    return f"""
with feed as ({feed}), target as ({target}), newest as ({newest_sql("feed", ks)}),
dead as (select distinct {ks} from newest where op = 'd'),
live as (select {row} from newest n where op <> 'd'
         and not exists (select 1 from dead d where {" and ".join(f"d.{k} = n.{k}" for k in keys)}))
select {row} from target t
where not exists (select 1 from newest n where {" and ".join(f"n.{k} = t.{k}" for k in keys)})
union all select {row} from live"""
