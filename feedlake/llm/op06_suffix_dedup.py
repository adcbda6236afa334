"""Substring dedup on bytes: suffix arrays over shards, merged by binary search.

Every byte covered by a string of ``size`` bytes that also starts anywhere else, in the same
text or another, is removed. Texts come to the shards that can hold a repetition of theirs as
super-windows (see ``windows``). A shard is sorted by Larsson-Sadakane refinement, Kasai's walk
gives the common prefixes of neighbours, and a window with ``size`` bytes in common with a
neighbour is repeated. Where the strings of one anchor fill several shards, the windows unique
within theirs are looked up in the ordered fingerprints of all by binary search.

Defined results: a null or empty text, and one of fewer than ``size`` bytes, loses nothing;
rows equal in id and text count as two places; ids may be null; further columns are ignored.
What is left may end within a character, so it is binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlake.llm.suffixes import common_prefixes, lay_out, suffix_array
from feedlake.llm.windows import covered, keyed, repeated_ranges
from feedlake.llm.words import chunks

#: Bytes hashed together to anchor a window.
ANCHOR_BYTES = 48


def judge(strings: list[np.ndarray], single: np.ndarray, size: int) -> list[np.ndarray]:
    """Whether each window of each string starts at another place of the shard."""
    text, at = lay_out(strings)
    sa = suffix_array(text, at)  # common prefixes are carried on only in full order
    shared = common_prefixes(text, at, sa, size)[sa] >= size
    repeated = np.zeros(len(text), bool)
    repeated[sa] = shared | np.concatenate([shared[1:], [False]])
    return [repeated[a : a + len(s) - size + 1] for a, s in zip(at, strings, strict=False)]


def remove_repeats(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept binary): per row the bytes left."""
    texts = keyed(docs)
    ranges = repeated_ranges(texts, "byte", size, min(ANCHOR_BYTES, size), judge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                gone = covered(batch.column(2).slice(chunk.first, chunk.last - chunk.first), chunk.at)
                removed, spans, kept = [], [], []
                for a, b in zip(chunk.at, chunk.at[1:], strict=False):
                    out = gone[a:b]
                    removed.append(int(out.sum()))
                    spans.append(int(np.count_nonzero(np.diff(out.astype(np.int8), prepend=0) == 1)))
                    kept.append((chunk.data[a:b][~out] if removed[-1] else chunk.data[a:b]).tobytes())
                ids = batch.column(0).slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.diff(chunk.at)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    joined = texts.join(ranges, ["d", "h"], "left").select("doc_id", "text", "ranges")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")


def brute_force(texts: list[str | None], size: int) -> list[bytes]:
    """The bytes left of each text; for tests."""
    coded = [(t or "").encode() for t in texts]
    starts: dict[bytes, int] = {}
    for own in coded:
        for i in range(len(own) - size + 1):
            starts[own[i : i + size]] = starts.get(own[i : i + size], 0) + 1
    out = []
    for own in coded:
        gone = np.zeros(len(own), bool)
        for i in range(len(own) - size + 1):
            if starts[own[i : i + size]] > 1:
                gone[i : i + size] = True
        out.append(bytes(np.frombuffer(own, np.uint8)[~gone]))
    return out
