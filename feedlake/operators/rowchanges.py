"""Row changes as plain selects: each row gets the action taken on it.

``actions`` frames hold the table's columns plus ``ACTION``; ``resolve`` turns one into
the new table content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from feedlake.functions.expressions import as_assignments, as_condition, is_true

ACTION = "_fl_action"
KEPT, UPDATED, DELETED, INSERTED = "kept", "updated", "deleted", "inserted"
METRICS = {"rows_inserted": INSERTED, "rows_updated": UPDATED, "rows_deleted": DELETED, "rows_kept": KEPT}


def resolve(actions: DataFrame) -> DataFrame:
    """The table after the changes."""
    return actions.filter(F.col(ACTION) != DELETED).drop(ACTION)


def metric_columns() -> list[Column]:
    """Row counts per action, for ``agg`` or ``observe``."""
    return [F.count_if(F.col(ACTION) == a).alias(name) for name, a in METRICS.items()]


def change_metrics(actions: DataFrame) -> DataFrame:
    return actions.agg(*metric_columns())


def target_columns(schema: StructType, assignments: dict[str, Column], name: str) -> dict[str, Column]:
    """Assignments by the table's own column names; unknown names are an error."""
    known = {f.name.lower(): f.name for f in schema.fields}
    unknown = [c for c in assignments if c.lower() not in known]
    if unknown:
        raise ValueError(f"{name}: the table has no column {unknown}")
    return {known[c.lower()]: e for c, e in assignments.items()}


def delete_actions(df: DataFrame, condition=None) -> DataFrame:
    hit = is_true(as_condition(condition))
    return df.withColumn(ACTION, F.when(hit, DELETED).otherwise(KEPT))


def update_actions(df: DataFrame, set, condition=None) -> DataFrame:
    values = target_columns(df.schema, as_assignments(set), "set")
    hit = is_true(as_condition(condition))
    # Every right-hand side sits in this one select, so all see the old values.
    return df.select(
        *[
            F.when(hit, values[f.name].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)
            if f.name in values
            else F.col(f.name)
            for f in df.schema.fields
        ],
        F.when(hit, UPDATED).otherwise(KEPT).alias(ACTION),
    )


def delete_where(df: DataFrame, condition=None) -> DataFrame:
    """Rows left after deleting where ``condition`` is true; None deletes all rows."""
    predicate = as_condition(condition)
    return df.filter(F.lit(False) if predicate is None else ~is_true(predicate))


def update_where(df: DataFrame, set, condition=None) -> DataFrame:
    """The table with ``set`` applied where ``condition`` is true, or to every row."""
    return update_actions(df, set, condition).drop(ACTION)
