"""Windows of a fixed length that occur more than once, found over sharded super-windows.

A *unit* is a word or a byte; a *window* is W units in a row of one text. Each window has an
anchor: the smallest hash among its runs of k units. Equal windows have equal anchors, so they
can be judged where their anchor is. Neighbouring windows with one anchor form a super-window,
which overlaps the next by W-1 units only.

1. ``occurrences``: the super-windows of all texts, as hashes. Nothing but their places moves.
2. ``contexts``: equal super-windows are counted together, before the shuffle too; anchors that
   occur once drop out: the windows of a super-window with one place of its anchor all differ. A
   super-window that occurs twice has all its windows repeated.
3. Super-windows that occur once, but whose anchor has others, go into shards with one copy of
   each of those others; what is repeated in a shard is for the caller's index to say. An anchor
   with more of them than a shard takes is dealt over several shards by content, and these
   shards also give fingerprints of their windows, which are sorted and searched afterwards.
4. The ranges found are gathered per text.

A third of all texts sharing a passage thus meets as one counted row; where its surroundings
differ, as rows that are split over shards of bounded size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import stage
from feedlake.llm.words import PLAIN, PLAIN_WORD, Chunk, Rolling, chunks, mix, words

#: Units that a shard takes; super-windows of one anchor that a shard takes.
SHARD_UNITS = {"word": 200_000, "byte": 1_000_000}

#: Fingerprints are merged in so many buckets, by their first bits.
BUCKET_BITS = 8
MARKS = pa.list_(pa.int64())
PLACES = pa.list_(pa.struct([("i", pa.int32()), ("d", pa.int64()), ("h", pa.int32()), ("start", pa.int32())]))



def keyed(docs: DataFrame) -> DataFrame:
    """(d, h, doc_id, text): what rows are joined by later; null ids count as 0 there."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("d"), F.hash("doc_id", "text").alias("h"), F.col("doc_id"), F.col("text")
    )


def _sliding_least(x: np.ndarray, w: int) -> np.ndarray:
    """Least of each w values in a row: from the least of block ends and of block starts."""
    n = len(x) - w + 1
    padded = np.concatenate([x, np.full(-len(x) % w, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    back = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def super_windows(values: np.ndarray, at: np.ndarray, size: int, k: int) -> tuple[np.ndarray, ...]:
    """(text, first window, windows, anchor, context hash, places of the anchor in it) of each
    super-window of the texts that begin at ``at``; windows are counted from a text's start."""
    n, w = len(values), size - k + 1
    if n < size:
        return tuple(np.zeros(0, kind) for kind in (np.int64, np.int64, np.int64, np.uint64, np.uint64, np.int64))
    rolling = Rolling(values)
    grams = rolling.grams(k)
    anchor = _sliding_least(grams, w)
    lengths = np.diff(at)
    end = np.repeat(at[1:], lengths)[: n - size + 1]
    place = np.arange(n - size + 1)
    inside = place + size <= end
    starts = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (end[1:] != end[:-1])]) | ~inside
    run = np.flatnonzero(starts)
    run = run[inside[run]]
    stop = np.concatenate([np.flatnonzero(starts), [len(place)]])
    stop = stop[np.searchsorted(stop, run, "right")]
    # A run of equal windows, as in periodic text, is cut into pieces of w windows.
    pieces = -(-(stop - run) // w)
    first = np.repeat(run, pieces) + w * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    last = np.minimum(first + w, np.repeat(stop, pieces))
    text = np.searchsorted(at, first, "right") - 1
    held = last - first + w - 1
    begin = np.cumsum(held) - held
    own = grams[np.arange(held.sum()) + np.repeat(first - begin, held)] == np.repeat(anchor[first], held)
    places = np.add.reduceat(own, begin, dtype=np.int64) if len(first) else np.zeros(0, np.int64)
    return text, first - at[text], last - first, anchor[first], rolling.of(first, last + size - 1), places


def units(chunk: Chunk, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """The units of a chunk's texts as numbers, and where each text begins among them."""
    if unit == "byte":
        return chunk.data, chunk.at
    w = words(chunk, PLAIN, PLAIN_WORD)
    return w.hash, w.at


def occurrences(texts: DataFrame, unit: str, size: int, k: int) -> DataFrame:
    """(d, h, start, n, anchor, ctx, again) of every super-window, again if its anchor has several
    places in it; staged, as it is used twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d, h = batch.column(0), batch.column(1)
            for chunk in chunks(batch.column(2)):
                values, at = units(chunk, unit)
                text, start, n, anchor, ctx, places = super_windows(values, at, size, k)
                took = pa.array(text + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [d.take(took), h.take(took), pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(anchor.view(np.int64)), pa.array(ctx.view(np.int64)), pa.array(places > 1)],
                    ["d", "h", "start", "n", "anchor", "ctx", "again"],
                )

    return stage(texts.select("d", "h", "text").mapInArrow(run, "d long, h int, start int, n int, anchor long, ctx long, again boolean"))


def contexts(found: DataFrame, unit: str, size: int) -> DataFrame:
    """One row per different super-window of an anchor with at least two places: how often
    it occurs (c), a place of it (ref), how many the anchor has (n_ctx), and into how many
    shards they are dealt (parts)."""
    each = found.groupBy("anchor", "ctx").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again"), F.min(F.struct("d", "h", "start", "n")).alias("ref"))
    anchors = each.groupBy("anchor").agg(F.sum("c").alias("total"), F.max("again").alias("some"), F.count(F.lit(1)).alias("n_ctx"))
    anchors = anchors.where("total >= 2 or some").drop("some")
    most = max(1, SHARD_UNITS[unit] // (2 * size))
    return stage(each.join(anchors, "anchor").withColumn("parts", F.ceil(F.col("n_ctx") / most).cast("int")).drop("total"))


def _cut(texts: DataFrame, wanted: DataFrame, unit: str, size: int) -> DataFrame:
    """(shard, part, parts, anchor, c, d, h, start, held): the units of each wanted super-window."""
    lists = wanted.groupBy("d", "h").agg(F.collect_list(F.struct("start", "n", "anchor", "c", "parts", "shard", "part")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(3)
            for chunk in chunks(batch.column(2)):
                if unit == "word":
                    w = words(chunk, PLAIN, PLAIN_WORD)
                mine = spans.slice(chunk.first, chunk.last - chunk.first)
                rows = mine.flatten()
                text = np.repeat(np.arange(len(mine)), np.asarray(pa.compute.list_value_length(mine)))
                start, n = np.asarray(rows.field("start"), np.int64), np.asarray(rows.field("n"), np.int64)
                if unit == "word":
                    begin, stop = w.at[text] + start, w.at[text] + start + n + size - 1
                    held = [b" ".join(chunk.data[w.start[i] : w.end[i]].tobytes() for i in range(a, b)) for a, b in zip(begin, stop, strict=True)]
                else:
                    begin = chunk.at[text] + start
                    held = [chunk.data[a:b].tobytes() for a, b in zip(begin, begin + n + size - 1, strict=True)]
                took = pa.array(text + chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [rows.field(x) for x in ("shard", "part", "parts", "anchor", "c")] + [batch.column(0).take(took), batch.column(1).take(took), rows.field("start"), pa.array(held, pa.binary())],
                    ["shard", "part", "parts", "anchor", "c", "d", "h", "start", "held"],
                )

    return texts.join(lists, ["d", "h"]).select("d", "h", "text", "spans").mapInArrow(
        run, "shard long, part int, parts int, anchor long, c long, d long, h int, start int, held binary"
    )


Judge = Callable[[list[np.ndarray], np.ndarray, int], list[np.ndarray]]


def _strings(held: pa.Array, unit: str) -> list[np.ndarray]:
    if unit == "byte":
        return [np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64) + 1 for x in held]
    split = [x.as_py().split(b" ") for x in held]
    ids: dict[bytes, int] = {}
    return [np.array([ids.setdefault(x, len(ids) + 1) for x in one], np.int64) for one in split]


def _marks(table: pa.Table, unit: str, size: int, repeated: list[np.ndarray], single: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of the windows of anchors dealt over several shards: sorted different fingerprints, and
    for those that this shard has once, in a text of its own, the string and window it is."""
    shared = np.flatnonzero(np.asarray(table["parts"].combine_chunks()) > 1)
    anchor = np.asarray(table["anchor"].combine_chunks()).view(np.uint64)
    mark, string, window, is_open = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, bool)]
    for i in shared:
        data = np.frombuffer(table["held"][int(i)].as_py(), np.uint8)
        grams = Rolling(units(Chunk(0, 1, data, np.array([0, len(data)])), unit)[0]).grams(size)
        mark.append(mix(grams ^ anchor[i]))
        string.append(np.full(len(grams), i))
        window.append(np.arange(len(grams)))
        is_open.append(~repeated[i] & single[i])
    mark, string, window, is_open = map(np.concatenate, (mark, string, window, is_open))
    _, first, counts = np.unique(mark, return_index=True, return_counts=True)
    return mark[first], string[first], window[first], is_open[first] & (counts == 1)


def _judged(cut: DataFrame, unit: str, size: int, judge: Judge) -> DataFrame:
    """Ranges (d, h, start, stop) of the units of repeated windows; and, for anchors that several
    shards share, lists of fingerprints (marks, in order) with the places of those (at, by their
    place in the list) that are unique so far: one row per shard and bucket of fingerprints."""
    kind = "d long, h int, start int, stop int, bucket int, marks array<long>, at array<struct<i:int,d:long,h:int,start:int>>"

    def run(table: pa.Table) -> pa.Table:
        single = np.asarray(table["c"].combine_chunks()) == 1
        repeated = judge(_strings(table["held"].combine_chunks(), unit), single, size)
        d, h = table["d"].combine_chunks(), table["h"].combine_chunks()
        start = np.asarray(table["start"].combine_chunks(), np.int64)
        row, low, high = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i in np.flatnonzero(single):
            edge = np.diff(np.concatenate([[0], repeated[i].astype(np.int8), [0]]))
            begin, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            row.append(np.full(len(begin), i)), low.append(start[i] + begin), high.append(start[i] + stop + size - 1)
        took = pa.array(np.concatenate(row))
        none = pa.nulls(len(took))
        ranges = {"d": d.take(took), "h": h.take(took), "start": pa.array(np.concatenate(low).astype(np.int32)), "stop": pa.array(np.concatenate(high).astype(np.int32)), "bucket": none.cast(pa.int32()), "marks": none.cast(MARKS), "at": none.cast(PLACES)}
        mark, string, window, is_open = _marks(table, unit, size, repeated, single)
        bucket = (mark >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        kept = np.unique(bucket)
        at = np.searchsorted(bucket, kept, "left")
        some = np.flatnonzero(is_open)
        places = pa.StructArray.from_arrays(
            [
                pa.array((some - at[np.searchsorted(kept, bucket[some])]).astype(np.int32)), d.take(pa.array(string[some])), h.take(pa.array(string[some])), pa.array((start[string[some]] + window[some]).astype(np.int32)),
            ],
            ["i", "d", "h", "start"],
        )
        ends = np.concatenate([at, [len(mark)]])
        lists = pa.ListArray.from_arrays(ends.astype(np.int32), pa.array(mark.view(np.int64)))
        where = pa.ListArray.from_arrays(np.searchsorted(some, ends).astype(np.int32), places)
        none = pa.nulls(len(kept))
        marks = {"d": none.cast(pa.int64()), "h": none.cast(pa.int32()), "start": none.cast(pa.int32()), "stop": none.cast(pa.int32()), "bucket": pa.array(kept.astype(np.int32)), "marks": lists, "at": where.cast(PLACES)}
        return pa.concat_tables([pa.table(ranges), pa.table(marks)])

    return stage(cut.groupBy("shard").applyInArrow(run, kind))


def _merged(judged: DataFrame, size: int) -> DataFrame:
    """Ranges whose windows are unique in their own shard, but not among the shards of their anchor.

    Each shard lists a fingerprint once, so it is repeated if two lists have it: the lists of a
    bucket are merged in order, and each open fingerprint is looked up by binary search.
    """

    def run(table: pa.Table) -> pa.Table:
        lists, at = table["marks"].combine_chunks(), table["at"].combine_chunks()
        marks = np.asarray(lists.flatten()).view(np.uint64)
        begin = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(lists)))])[:-1]
        places = at.flatten()
        own = marks[np.asarray(places.field("i"), np.int64) + np.repeat(begin, np.asarray(pa.compute.list_value_length(at)))]
        ordered = np.sort(marks)
        again = np.searchsorted(ordered, own, "right") - np.searchsorted(ordered, own, "left") >= 2
        rows = places.filter(pa.array(again))
        return pa.table({"d": rows.field("d"), "h": rows.field("h"), "start": rows.field("start"), "stop": pa.compute.add(rows.field("start"), pa.scalar(size, pa.int32()))})

    listed = judged.where("marks is not null").select("bucket", "marks", "at")
    return listed.groupBy("bucket").applyInArrow(run, "d long, h int, start int, stop int")


def repeated_ranges(texts: DataFrame, unit: str, size: int, k: int, judge: Judge) -> DataFrame:
    """(d, h, ranges): per text with any, the ranges of units that repeated windows cover.

    ``judge`` gets the strings of a shard, which of them occur once, and the window size, and
    says for each window of each of those whether it starts at a second place in the shard.
    """
    found = occurrences(texts, unit, size, k)
    ctx = contexts(found, unit, size)
    again = found.join(ctx.where("c >= 2").select("anchor", "ctx"), ["anchor", "ctx"]).select(
        "d", "h", "start", (F.col("start") + F.col("n") + F.lit(size - 1)).alias("stop")
    )
    unsure = ctx.where("n_ctx >= 2 or (again and c = 1)")
    total = unsure.agg(F.sum(F.col("ref.n") + F.lit(size))).first()[0] or 0
    shards = max(1, -(-total // SHARD_UNITS[unit]))
    wanted = (
        unsure.withColumn("part", F.pmod("ctx", F.col("parts")).cast("int"))
        .withColumn("shard", F.pmod(F.xxhash64("anchor", "part"), F.lit(shards)))
        .select("ref.*", "anchor", F.col("c").cast("long").alias("c"), "parts", "shard", "part")
    )
    judged = _judged(_cut(texts, wanted, unit, size), unit, size, judge)
    sure = judged.where("marks is null").select("d", "h", "start", "stop")
    ranges = again.union(sure).union(_merged(judged, size))
    return ranges.groupBy("d", "h").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))


def covered(lists: pa.Array, at: np.ndarray) -> np.ndarray:
    """Which units of a chunk the ranges of its texts cover."""
    change = np.zeros(int(at[-1]) + 1, np.int64)
    sizes = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0))
    rows = lists.flatten()
    base = np.repeat(at[:-1], sizes)
    np.add.at(change, base + np.asarray(rows.field("start"), np.int64), 1)
    np.add.at(change, base + np.asarray(rows.field("stop"), np.int64), -1)
    return np.cumsum(change[:-1]) > 0
