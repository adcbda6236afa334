"""Names derived from a topic ``<database>.<schema>.<table>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def topic_parts(topic: str) -> tuple[str, str, str]:
    parts = topic.split(".")
    if len(parts) != 3 or not all(parts):
        raise ValueError(f"topic must be <database>.<schema>.<table>, got {topic!r}")
    return parts[0], parts[1], parts[2]


def topic_path(prefix: str, topic: str) -> str:
    """Folder of a topic: ``<prefix>/<schema>/<topic>``."""
    return f"{prefix.rstrip('/')}/{topic_parts(topic)[1]}/{topic}"


def table_alias(topic: str) -> str:
    return topic_parts(topic)[2]


def catalog_name(topic: str) -> str:
    return topic.replace(".", "_")


def topic_path_col(prefix: str, topic: Column) -> Column:
    return F.concat_ws("/", F.lit(prefix.rstrip("/")), F.split_part(topic, F.lit("."), F.lit(2)), topic)


def table_alias_col(topic: Column) -> Column:
    return F.split_part(topic, F.lit("."), F.lit(3))


def catalog_name_col(topic: Column) -> Column:
    return F.translate(topic, ".", "_")


def route(feed: DataFrame, topics: list[str], prefix: str, topic: str = "topic") -> DataFrame:
    """Keep the included topics of a multi-table feed and name where each row belongs."""
    t = F.col(topic)
    return feed.filter(t.isin(list(topics))).withColumns(
        {
            "path": topic_path_col(prefix, t),
            "table_alias": table_alias_col(t),
            "catalog_name": catalog_name_col(t),
        }
    )
