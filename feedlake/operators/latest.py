"""The newest change per key.

No form puts all rows of a key into one task. Ties are found by a hash aggregate
(combined map-side) and a join on key *and* time, so the rows of a hot key spread by
time, and a hot tie is a join partition that adaptive execution splits. Where one row
per key is enough, ``row_number() <= n`` lets Spark drop all but n rows of a key in
every map task before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from feedlake.functions.expressions import all_of

_PREFIX = "_fl_"


def newest_ts(df: DataFrame, keys: list[str], ts: str = "ts_ms", **extra: Column) -> DataFrame:
    """Per key group (nulls form a group): keys as ``_fl_k<i>``, newest time as ``_fl_max``."""
    grouped = df.select(
        *[F.col(k).alias(f"{_PREFIX}k{i}") for i, k in enumerate(keys)],
        F.col(ts).alias(f"{_PREFIX}ts"),
        *[c.alias(f"{_PREFIX}{n}") for n, c in extra.items()],
    ).groupBy(*[f"{_PREFIX}k{i}" for i in range(len(keys))])
    return grouped.agg(
        F.max(f"{_PREFIX}ts").alias(f"{_PREFIX}max"),
        *[F.max(f"{_PREFIX}{n}").alias(f"{_PREFIX}max_{n}") for n in extra],
    )


def same_group(keys: list[str]) -> Column:
    """Null-safe match of a row with its ``newest_ts`` group."""
    return all_of(F.col(k).eqNullSafe(F.col(f"{_PREFIX}k{i}")) for i, k in enumerate(keys))


def with_group_max(df: DataFrame, keys: list[str], ts: str = "ts_ms", name: str = "ts_ms_max") -> DataFrame:
    """Every row with the newest time of its key group."""
    top = newest_ts(df, keys, ts)
    joined = df.join(top, same_group(keys), "left_outer")
    return joined.select(*[F.col(c) for c in df.columns], F.col(f"{_PREFIX}max").alias(name))


def first_per_key(
    df: DataFrame, keys: list[str], order: list[Column], flag: str | None = None, alike: list[str] | None = None
) -> DataFrame:
    """One row per key group by ``order``; ``flag`` tells whether the group had more rows, or,
    with ``alike``, whether the second one has the same values there.

    At most two rows per key leave a map task, however hot the key is. The window
    partitions by the keys as one struct, so that a join on the key columns still places
    an exchange of its own on the result: only then may adaptive execution split a skewed
    partition of the other side, and a bucketed other side is never shuffled to match.
    """
    group, rank = f"{_PREFIX}group", f"{_PREFIX}rank"
    w = Window.partitionBy(group).orderBy(*order)
    ranked = df.withColumn(group, F.struct(*keys)).withColumn(rank, F.row_number().over(w))
    if flag is None:
        return ranked.filter(F.col(rank) <= 1).drop(group, rank)
    second = F.lead(F.struct(*(alike or [rank]))).over(w)
    return (
        ranked.filter(F.col(rank) <= 2)
        .withColumn(flag, F.coalesce(second == F.struct(*alike), F.lit(False)) if alike else second.isNotNull())
        .filter(F.col(rank) == 1)
        .drop(group, rank)
    )


def settle(df: DataFrame, tie_break: list[Column | str]) -> list[Column]:
    """An order from ``tie_break`` (a name means descending), settled by all comparable
    columns, so that a rerun picks the same row again."""
    order = [F.desc(c) if isinstance(c, str) else c for c in tie_break]
    named = {c for c in tie_break if isinstance(c, str)}
    comparable = [n for n, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    return order + [F.desc(n) for n in comparable if n not in named]


def latest_per_key(
    df: DataFrame, keys: list[str], ts: str = "ts_ms", tie_break: list[Column | str] | None = None
) -> DataFrame:
    """Rows whose time is the newest of their key; rows without a time are left out.

    Without ``tie_break`` all rows of a tie stay. With it (columns, preferred value first;
    a name means descending) exactly one row per key stays.
    """
    timed = df.filter(F.col(ts).isNotNull())
    if tie_break is not None:
        return first_per_key(timed, keys, [F.col(ts).desc(), *settle(timed, tie_break)])
    top = newest_ts(timed, keys, ts)
    return timed.join(top, same_group(keys) & (F.col(ts) == F.col(f"{_PREFIX}max")), "left_semi")
