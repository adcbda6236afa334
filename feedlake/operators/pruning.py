"""Rows of a table that a batch cannot touch, told apart before anything moves.

A batch too large to be broadcast can still be far smaller than the table. Its keys are then set
as bits in a bitmap of fixed size, by hash, which is broadcast; rows of the table whose bit is not
set match nothing and go past the join. A set bit is only a chance: those rows are joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from feedlake.functions.expressions import fits_broadcast, plan_size

#: Bits of the map: 4,096 rows of 4 KB, so 16 MB are broadcast however many keys there are.
BITS = 1 << 27
#: How many times larger than the batch a table must be for a second scan of it to pay.
TIMES = 8
_BUCKET, _BITMAP = "_fl_bitmap_bucket", "_fl_bitmap"


def _place(keys: list[Column]) -> Column:
    """The bit of a key; null if the key is not complete."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & key.isNotNull()
    return F.when(complete, F.pmod(F.xxhash64(*keys), F.lit(BITS)))


def prunes(target: DataFrame, target_keys: list[Column], batch: DataFrame, batch_keys: list[Column]) -> bool:
    """Whether a bitmap of the batch's keys saves more than it costs, and hashes both sides alike."""
    if fits_broadcast(batch) or plan_size(batch) * TIMES > plan_size(target):
        return False
    kinds = [[f.dataType for f in df.select(*keys).schema.fields] for df, keys in ((target, target_keys), (batch, batch_keys))]
    return kinds[0] == kinds[1] and not any("collate" in k.simpleString() or "map<" in k.simpleString() for k in kinds[0])


def bitmap(batch: DataFrame, keys: list[Column]) -> DataFrame:
    """The bits of the batch's keys, 32,768 a row; set in every map task before they move."""
    placed = batch.select(_place(keys).alias("p")).where("p is not null")
    grouped = placed.groupBy(F.bitmap_bucket_number("p").alias(_BUCKET))
    return grouped.agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias(_BITMAP))


def split(target: DataFrame, target_keys: list[Column], bits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may match, rows that cannot), rows without a complete key among the latter."""
    place = _place(target_keys)
    bit = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring(F.col(_BITMAP), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.coalesce(F.call_function("shiftright", byte, (bit % 8).cast("int")) % 2 == 1, F.lit(False))
    marked = target.withColumn(_BUCKET, F.bitmap_bucket_number(place)).join(F.broadcast(bits), _BUCKET, "left_outer")
    own = [F.col(f"`{c}`") for c in target.columns]
    return marked.where(is_set).select(*own), marked.where(~is_set).select(*own)
