"""Arguments that may be SQL text or a Column, checked before any planning."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def as_condition(condition, name: str = "condition") -> Column | None:
    """A predicate from SQL text or a Column; None stays None."""
    if condition is None or isinstance(condition, Column):
        return condition
    if isinstance(condition, str):
        return F.expr(condition)
    raise TypeError(f"{name}: expected SQL text or a Column, got {type(condition).__name__}")


def as_assignments(assignments, name: str = "set") -> dict[str, Column]:
    """Column name -> value expression, from a dict of SQL text or Columns."""
    if assignments is None:
        raise ValueError(f"{name}: a dict of assignments is required")
    if not isinstance(assignments, dict):
        raise TypeError(f"{name}: expected a dict, got {type(assignments).__name__}")
    out = {}
    for column, value in assignments.items():
        if not isinstance(column, str):
            raise TypeError(f"{name}: column names must be str, got {type(column).__name__}")
        if not isinstance(value, (str, Column)):
            raise TypeError(
                f"{name}[{column!r}]: expected SQL text or a Column, got {type(value).__name__}"
            )
        out[column] = as_condition(value)
    return out


def is_true(condition: Column | None) -> Column:
    """Null counts as false, as in MERGE, UPDATE and DELETE; None is always true."""
    return F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))


def all_of(conditions) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))


def none_null(keys: list[str]) -> Column:
    return all_of(F.col(k).isNotNull() for k in keys)


def gather(rows: DataFrame, by) -> DataFrame:
    """Rows alike in the expressions ``by`` brought together; adaptive execution splits
    large groups and joins small ones, so files come out few and of even size."""
    names = {f"_fl_by{i}": expression for i, expression in enumerate(by)}
    if not names:
        return rows
    # The hint takes columns only.
    return rows.withColumns(names).hint("rebalance", *[F.col(n) for n in names]).drop(*names)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark, by its own estimate and threshold, would broadcast ``df``."""
    return plan_size(df) <= df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def plan_size(df: DataFrame) -> int:
    """Spark's estimate of the bytes of ``df``."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
