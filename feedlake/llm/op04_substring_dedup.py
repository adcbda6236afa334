"""Substring dedup on words: FM-indexes over shards, searched backwards by streamed texts.

Every word covered by a run of ``size`` words that also starts anywhere else, in the same text
or another, is removed. Texts come to the shards that can hold a repetition of theirs as
super-windows (see ``windows``); a shard's FM-index (sampled Burrows-Wheeler order, wavelet
tree) gives, by backward search, the matching statistics of each text streamed against it:
at each end, the longest string that starts at two places or more. Ends where it reaches
``size`` close a repeated window.

Defined results: a null or empty text, and a text of fewer than ``size`` words, loses nothing;
rows equal in id and text count as two places; ids may be null; further columns are ignored.
Long texts are cut into super-windows, so none is ever whole in one shard.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from feedlake.llm.suffixes import FMIndex, lay_out
from feedlake.llm.windows import covered, keyed, repeated_ranges
from feedlake.llm.words import PLAIN, PLAIN_WORD, chunks, words

#: Words hashed together to anchor a window: few enough for sparse anchors, enough to be rare.
ANCHOR_WORDS = 6


def judge(strings: list[np.ndarray], single: np.ndarray, size: int) -> list[np.ndarray]:
    """Whether each window of each string that occurs once starts at another place of the shard."""
    text, at = lay_out(strings)
    index = FMIndex(text, at, size)
    windows = np.array([len(s) - size + 1 for s in strings])
    asked = np.flatnonzero(single)
    n = windows[asked]
    ends = np.repeat(at[asked] + size - np.cumsum(n) + n, n) + np.arange(n.sum())
    # A word that the shard has once is in no repeated window.
    lone = np.concatenate([[0], np.cumsum(index.counts[text] < 2)])
    maybe = np.flatnonzero(lone[ends] == lone[ends - size])
    hit = np.zeros(len(ends), bool)
    hit[maybe] = index.matching_statistics(text, ends[maybe], size) >= size
    out = [np.ones(w, bool) for w in windows]
    for i, found in zip(asked, np.split(hit, np.cumsum(n)[:-1]), strict=True):
        out[i] = found
    return out


def remove_repeats(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): per row the words left, joined by one space."""
    texts = keyed(docs)
    ranges = repeated_ranges(texts, "word", size, min(ANCHOR_WORDS, size), judge)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                lists = batch.column(2).slice(chunk.first, chunk.last - chunk.first)
                held = chunk.data.tobytes()
                n, removed, kept = [], [], []
                gone = None
                if lists.null_count < len(lists):
                    at = words(chunk, PLAIN, PLAIN_WORD).at
                    gone = covered(lists, at)
                for i, (a, b) in enumerate(zip(chunk.at, chunk.at[1:], strict=False)):
                    own = held[a:b].split()
                    n.append(len(own))
                    out = gone[at[i] : at[i + 1]] if gone is not None else ()
                    removed.append(int(np.sum(out)))
                    kept.append(b" ".join(compress(own, ~out) if removed[-1] else own))
                ids = batch.column(0).slice(chunk.first, chunk.last - chunk.first)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    joined = texts.join(ranges, ["d", "h"], "left").select("doc_id", "text", "ranges")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept string")


def brute_force(texts: list[str | None], size: int) -> list[list[str]]:
    """The words left of each text; for tests."""
    split = [(t or "").encode().split() for t in texts]
    starts: dict[tuple, int] = {}
    for own in split:
        for i in range(len(own) - size + 1):
            window = tuple(own[i : i + size])
            starts[window] = starts.get(window, 0) + 1
    out = []
    for own in split:
        gone = set()
        for i in range(len(own) - size + 1):
            if starts[tuple(own[i : i + size])] > 1:
                gone.update(range(i, i + size))
        out.append([w.decode() for i, w in enumerate(own) if i not in gone])
    return out


