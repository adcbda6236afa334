"""LM scoring by cross-entropy difference of a target and a background n-gram model.

Both models share a vocabulary, all words of all texts; with ``size`` only its most frequent ones,
other words are one unknown word then. Each is a bigram model interpolated with its
unigrams and a uniform share, P(w | v) = a c(v, w) / c(v) + b c(w) / N + (1 - a - b) / words.
A text's score is its mean loss per word under the target model minus that under the background
model: the lower, the more it is like the target.

The counts are those of every word and every bigram, told apart by hashes of 64 bits, and are held in no one place:

1. Texts are gathered into blocks of about ``BLOCK`` bytes, written as numbers of the block's own words.
2. Each block sends its different words, then its different bigrams, with their counts, to buckets
   by ranges of hashes, at most about ``ITEMS`` a bucket. A bucket adds up what all blocks
   and all target texts have of each, and sends every block the sums of what it sent.
3. A block meets its sums again and scores its texts.

A frequent word or bigram is sent once a block, so no key outgrows a task. The driver gets counts of
words, texts and kinds, and with ``size`` the vocabulary; nothing else is broadcast.

Defined results: null and empty texts, and texts without words, have null losses; without target
texts the target model is uniform; words of the target alone count in its total; ids may be null or
repeated; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from feedlake.llm.common import stage
from feedlake.llm.words import chunks, mix, words

#: Bytes of the texts of a block; words or bigrams that a bucket gets of all blocks.
BLOCK, ITEMS = 1 << 23, 1 << 20
BIGRAM_SHARE, UNIGRAM_SHARE = 0.6, 0.35
#: Hashes of the unknown word, and of what stands before the first word of a text.
UNKNOWN, START = np.uint64(0), np.uint64(0x9E3779B97F4A7C15)
#: Rows of a block are large: Parquet is to look at their size after each.
_LARGE = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(1 << 25)}


def vocabulary(docs: DataFrame, size: int) -> np.ndarray:
    """Hashes of the most frequent words, sorted; ties go to the smaller hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words(chunk).hash for chunk in chunks(batch.column(0))]
            word, count = np.unique(np.concatenate([np.zeros(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(count)], ["word", "n"])

    counted = docs.select("text").mapInArrow(run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    top = counted.orderBy(F.desc("n"), "word").limit(size - 2).select("word").toArrow()
    return np.sort(np.asarray(top["word"].combine_chunks()).view(np.uint64))


def _packed(values: np.ndarray) -> bytes:
    """The first bytes of all values, then their second ones and so on, compressed, after the number of all."""
    planes = np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(values.size, values.itemsize).T)
    return planes.nbytes.to_bytes(8, "little") + pa.compress(planes, "zstd", asbytes=True)


def _values(packed: pa.BinaryScalar, kind: type) -> np.ndarray:
    held = packed.as_buffer()
    size = int.from_bytes(held[:8].to_pybytes(), "little")
    planes = np.frombuffer(pa.decompress(held[8:], size, "zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _texts_of(lengths: pa.BinaryScalar, numbers: pa.BinaryScalar, held: pa.BinaryScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: how many words each text has, their numbers, and its words, sorted by hash."""
    word = _values(held, np.uint64)
    order = np.argsort(word)
    place = np.empty(len(word), np.int64)
    place[order] = np.arange(len(word))
    return _values(lengths, np.int64), place[_values(numbers, np.int32)], word[order]


def _blocks(docs: DataFrame, known: np.ndarray | None) -> DataFrame:
    """(block, ids, lengths, numbers, words, n_words, n_kinds, n_texts) per block: its ids, the words of
    each text, the numbers of those among the block's words, the most frequent first; texts without
    words are not among the ``n_texts``."""
    kind, most = docs.schema["doc_id"].dataType.simpleString(), BLOCK
    held = None if known is None else docs.sparkSession.sparkContext.broadcast(known)
    schema = f"block long, ids array<{kind}>, lengths binary, numbers binary, words binary, n_words long, n_kinds long, n_texts long"
    names = [c.split(" ")[0] for c in schema.split(", ")]

    def row(block: int, ids: list[pa.Array], hashes: list[np.ndarray], lengths: list[np.ndarray]) -> pa.RecordBatch:
        word, n, id_ = np.concatenate(hashes), np.concatenate(lengths).astype(np.int64), pa.concat_arrays(ids)
        if held is not None:
            own = held.value
            place = np.minimum(np.searchsorted(own, word), max(0, len(own) - 1))
            word = np.where(own[place] == word, word, UNKNOWN) if len(own) else np.full(len(word), UNKNOWN)
        kinds, number, times = np.unique(word, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        rank = np.empty(len(kinds), np.int32)
        rank[order] = np.arange(len(kinds))
        one = [[block], None, [_packed(n)], [_packed(rank[number])], [_packed(kinds[order])], [len(word)], [len(kinds)], [int(np.count_nonzero(n))]]
        one[1] = pa.ListArray.from_arrays(pa.array([0, len(id_)], pa.int32()), id_)
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in one], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        size, gathered = 0, ([], [], [])
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                w = words(chunk)
                for x, part in zip(gathered, (batch.column(0).slice(chunk.first, chunk.last - chunk.first), w.hash, np.diff(w.at)), strict=True):
                    x.append(part)
                size += len(chunk.data) + chunk.last - chunk.first
                if size >= most:
                    yield row(block, *gathered)
                    block, size, gathered = block + 1, 0, ([], [], [])
        if size:
            yield row(block, *gathered)

    return stage(docs.select("doc_id", "text").mapInArrow(run, schema), **_LARGE)


def _before(number: np.ndarray, n: np.ndarray, first: int) -> np.ndarray:
    """The number before each, ``first`` for that of a text."""
    before = np.empty(len(number), np.int64)
    before[1:] = number[:-1]
    before[(np.cumsum(n) - n)[n > 0]] = first
    return before


def _bigrams(n: np.ndarray, number: np.ndarray, word: np.ndarray) -> np.ndarray:
    hashes = np.append(word, START)
    return mix(mix(hashes)[_before(number, n, len(word))] + hashes[number])


def _words_of(n: np.ndarray, number: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of a block and their counts: in all, and as the last of a text."""
    ends = np.bincount(number[np.cumsum(n)[n > 0] - 1], minlength=len(word))
    return word, np.stack([np.bincount(number, minlength=len(word)), ends])


def _bigrams_of(n: np.ndarray, number: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    bigram, count = np.unique(_bigrams(n, number, word), return_counts=True)
    return bigram, count[None]


def count(blocks: DataFrame, target: DataFrame, bigrams: bool, buckets: int) -> DataFrame:
    """(block, bigrams, bucket, kinds, counts) of what ``blocks`` have: counts over all ``blocks``,
    then over all of ``target``, of the words or bigrams of a block in the order of hashes, bucket by bucket.
    The ``kinds`` of all rows add up to the number of different ones in ``blocks``."""
    of, width = (_bigrams_of, 1) if bigrams else (_words_of, 2)
    cuts = np.array([(i << 64) // buckets for i in range(buckets)], np.uint64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, *held in zip(*batch.columns, strict=True):
                item, counts = of(*_texts_of(*held))
                at = np.append(np.searchsorted(item, cuts), len(item))
                some = np.flatnonzero(np.diff(at))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(some.astype(np.int32)),
                        pa.array([block.as_py()] * len(some), pa.int64()),
                        pa.array([_packed(item[at[i] : at[i + 1]]) for i in some], pa.binary()),
                        pa.array([_packed(counts[:, at[i] : at[i + 1]]) for i in some], pa.binary()),
                    ],
                    ["bucket", "block", "items", "counts"],
                )

    def add(table: pa.Table) -> pa.Table:
        block = table["block"].to_pylist()
        items = [_values(x, np.uint64) for x in table["items"]]
        at = np.cumsum([0, *map(len, items)])
        own, place = np.unique(np.concatenate(items), return_inverse=True)
        del items
        sums = np.zeros((2, width, len(own)), np.int64)
        for i, x in enumerate(table["counts"]):
            sums[int(block[i] is None), :, place[at[i] : at[i + 1]]] += _values(x, np.int64).reshape(width, -1).T
        rows = [i for i, b in enumerate(block) if b is not None]
        return pa.table(
            {
                "block": pa.array([block[i] for i in rows], pa.int64()),
                "bigrams": pa.array([bigrams] * len(rows), pa.bool_()),
                "bucket": table["bucket"].take(pa.array(rows, pa.int64())),
                "kinds": pa.array([int(np.count_nonzero(sums[0, 0])) if i == rows[0] else 0 for i in rows], pa.int64()),
                "counts": pa.array([_packed(sums[:, :, place[at[i] : at[i + 1]]]) for i in rows], pa.binary()),
            }
        )

    texts = ("lengths", "numbers", "words")
    both = (x.where("n_words > 0").select(b, *texts) for x, b in ((blocks, "block"), (target, F.lit(None).cast("long"))))
    dealt = reduce(DataFrame.union, both).mapInArrow(deal, "bucket int, block long, items binary, counts binary")
    return dealt.groupBy("bucket").applyInArrow(add, "block long, bigrams boolean, bucket int, kinds long, counts binary")


def losses(bigram: np.ndarray, context: np.ndarray, word: np.ndarray, total: int, kinds: int) -> np.ndarray:
    """Negative log-probability of each word, by the counts of its bigram, of the word before as such, and its own."""
    pair = bigram / np.maximum(context, 1)
    return -np.log(BIGRAM_SHARE * pair + UNIGRAM_SHARE * word / max(1, total) + (1 - BIGRAM_SHARE - UNIGRAM_SHARE) / kinds)


def score(docs: DataFrame, target: DataFrame, size: int | None = None) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_words, target_loss, background_loss, difference). The
    background model is of all of ``docs``, the target model of the texts of ``target``. With
    ``size`` only so many kinds of words are told apart, the unknown one and the start of a text included."""
    known = None if size is None else vocabulary(docs, size)
    blocks, wanted = _blocks(docs, known), _blocks(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), known)
    sums = [x.agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in ("n_words", "n_kinds", "n_texts"))).first() for x in (blocks, wanted)]
    n_words, n_kinds, n_texts = zip(*sums, strict=True)
    word_counts = stage(count(blocks, wanted, False, 1 + sum(n_kinds) // ITEMS), **_LARGE)
    found = word_counts.agg(F.coalesce(F.sum("kinds"), F.lit(0))).first()[0] if known is None else len(known)
    kinds = found + 2
    counts = word_counts.union(count(blocks, wanted, True, 1 + sum(n_words) // ITEMS)).drop("kinds")

    def run(block: pa.Table, answers: pa.Table) -> pa.Table:
        ids = block["ids"].combine_chunks().flatten()
        n, number, word = _texts_of(*(block[c][0] for c in ("lengths", "numbers", "words")))
        order = answers.sort_by([("bigrams", "ascending"), ("bucket", "ascending")])
        parts = [(x, _values(y, np.int64)) for x, y in zip(order["bigrams"].to_pylist(), order["counts"], strict=True)]
        of_words = np.concatenate([np.zeros((2, 2, 0), np.int64), *(x.reshape(2, 2, -1) for is_pair, x in parts if not is_pair)], axis=2)
        of_pairs = np.concatenate([np.zeros((2, 0), np.int64), *(x.reshape(2, -1) for is_pair, x in parts if is_pair)], axis=1)
        before, text = _before(number, n, len(word)), np.repeat(np.arange(len(n)), n)
        pair = np.unique(_bigrams(n, number, word), return_inverse=True)[1]
        mean = []
        for model in (1, 0):
            context = np.append(of_words[model, 0] - of_words[model, 1], n_texts[model])
            loss = losses(of_pairs[model][pair], context[before], of_words[model, 0][number], n_words[model], kinds)
            mean.append(np.bincount(text, weights=loss, minlength=len(n)) / np.maximum(n, 1))
        none = n == 0
        columns = [ids, pa.array(n), *(pa.array(x, mask=none) for x in (mean[0], mean[1], mean[0] - mean[1]))]
        return pa.table(columns, ["doc_id", "n_words", "target_loss", "background_loss", "difference"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    own = blocks.select("block", "ids", "lengths", "numbers", "words").groupBy("block")
    return own.cogroup(counts.groupBy("block")).applyInArrow(run, f"doc_id {kind}, n_words long, target_loss double, background_loss double, difference double")
