"""Which tables to keep current, and how."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType

from feedlake.functions.topics import catalog_name, table_alias, topic_path


@dataclass(frozen=True)
class TableConfig:
    topic: str
    primary_keys: list[str]
    big_table: bool = False
    publish_buckets: int = 256
    publish_view: bool = False  # publish a view of the staged snapshot, copying nothing
    staged_buckets: int | None = None
    staged_slices: int | str | None = None
    tie_break: list[str] | None = None
    guard: str | None = None
    tombstones: int | None = None  # how long deletions are remembered, in ms, so that none is undone by a late change
    timestamp_cols: list[str] = field(default_factory=list)
    ref_time_column: str | None = None
    partition: str | None = None
    row_schema: StructType | None = None
    format: str = "parquet"  # of the feed's files

    def __post_init__(self):
        self.alias  # checks the topic
        if not self.primary_keys:
            raise ValueError(f"{self.topic}: primary_keys is empty")
        if self.publish_view:
            ignored = [n for n in ("big_table", "timestamp_cols", "ref_time_column", "partition") if getattr(self, n)]
            if ignored:
                raise ValueError(f"{self.topic}: a published view has no effect of {ignored}")

    @classmethod
    def from_dict(cls, entry: dict) -> TableConfig:
        """From one entry of a table list; ``topic_name`` and text flags are understood."""
        values = dict(entry)
        if "topic_name" in values:
            values["topic"] = values.pop("topic_name")
        flag = values.get("big_table")
        values["big_table"] = flag.strip().lower() == "true" if isinstance(flag, str) else bool(flag)
        values["timestamp_cols"] = values.get("timestamp_cols") or []
        if isinstance(values.get("row_schema"), str):
            values["row_schema"] = StructType.fromDDL(values["row_schema"])
        unknown = set(values) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown table settings {sorted(unknown)}")
        return cls(**values)

    @property
    def alias(self) -> str:
        return table_alias(self.topic)

    @property
    def catalog_name(self) -> str:
        return catalog_name(self.topic)

    def path(self, prefix: str) -> str:
        return topic_path(prefix, self.topic)
