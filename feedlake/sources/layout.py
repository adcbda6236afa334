"""How the snapshots of a table are laid out on storage."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, functions as F

SLICE = "fl_slice"


@dataclass(frozen=True)
class Layout:
    """``buckets``: a snapshot is a table bucketed by the keys, known to the catalog
    ``database``. Merges and diffs read it without an exchange, and rewrite all of it.

    ``slices``: the table is partitioned by slice, a number that depends on the keys
    only; either a count (slices by key hash) or SQL text over the key columns, such as
    ``id div 1000000`` for keys given out in order. A batch reads and overwrites the
    partitions it touches. Earlier snapshots are not kept.

    Neither: one folder of Parquet files, rewritten as a whole.
    """

    keys: tuple[str, ...] = ()
    buckets: int | None = None
    database: str | None = None
    slices: int | str | None = None

    def __post_init__(self):
        if (self.buckets or self.slices) and not self.keys:
            raise ValueError("a bucketed or sliced table needs keys")
        if self.buckets and not self.database:
            raise ValueError("a bucketed table needs a catalog database")
        if self.buckets and self.slices:
            raise ValueError("a table is bucketed or sliced, not both")

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> Layout:
        values = json.loads(text)
        return cls(**{**values, "keys": tuple(values["keys"])})

    def slice_of(self) -> Column:
        """Slice of a row. Null results, from null keys, share slice -1."""
        if isinstance(self.slices, int):
            number = F.pmod(F.xxhash64(*self.keys), F.lit(self.slices))
        else:
            number = F.expr(self.slices)
        return F.coalesce(number.cast("long"), F.lit(-1).cast("long"))

    def file_columns(self) -> list[Column]:
        """What the rows of one file have in common, if anything."""
        if self.buckets:
            return [F.col(k) for k in self.keys]
        return [self.slice_of()] if self.slices else []
