"""Quality classifier: ordinal regression with cumulative links on graded ratings.

One weight vector over hashed features of a text gives its score s; ordered thresholds
t_0 < t_1 < ... give P(grade <= k) = logistic(t_k - s). So all grades share the weights, and a
text has an expected grade and a tail probability P(grade >= k), by which it is selected.

Features: each different word of a text counts once, however long the text; for the shapes of
its space-separated tokens (case, digits, punctuation with runs collapsed) and for words that
repeat the word before, the step of their share on a fixed scale. The features of a long text
count less each, so that it cannot outvote a defect by many words. Every weight has a ridge of
its own, the lower the further the mean grade of the feature's texts is from that of all, up or
down, in standard errors: chance words stay near zero, telling ones are free to move.
The model is fitted on the driver by Adam over at most ``max_rows`` rated texts, those whose
ids hash lowest, sent there as feature numbers; everything else is one pass over all texts,
and a shuffle of the rated ones.

Defined results: a null or empty text has no features and gets the prior of score 0; ratings
with a null id or grade are not used; of several ratings of one text each counts; without any
rating every text gets an equal chance of each grade. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from feedlake.llm.common import release
from feedlake.llm.words import PLAIN, PLAIN_WORD, Chunk, chunks, mix, words

BITS = 20
#: A feature gets a weight if so many rated texts have it.
LEAST_TEXTS = 3
#: The ridge of a weight is DECAY * (1 + (ERRORS / z)**4) for a mean grade z standard errors away;
#: chosen on held-out ratings.
DECAY, ERRORS = 0.005, 8.0
#: Features that count whole; each of n more counts as the root of this share of them.
FEATURES = 60
#: Steps of a share.
SHARES = np.array([0.01, 0.03, 0.1, 0.3, 0.6])

_letters = np.arange(256)
#: What bytes look like: A upper case, a lower case, 0 digit, u beyond ASCII; others stay.
_LOOKS = np.select(
    [(_letters >= 65) & (_letters <= 90), (_letters >= 97) & (_letters <= 122), (_letters >= 48) & (_letters <= 57), _letters >= 128],
    [ord("A"), ord("a"), ord("0"), ord("u")],
    _letters,
).astype(np.uint8)


def features(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """(text, feature) of a chunk's texts, by text."""
    mask = np.uint64((1 << BITS) - 1)
    w = words(chunk)
    n = len(chunk.at) - 1
    key = np.unique(w.text_of().astype(np.uint64) << np.uint64(BITS) | (w.hash & mask))
    text, feature = (key >> np.uint64(BITS)).astype(np.int64), (key & mask).astype(np.int64)

    looks = _LOOKS[chunk.data]
    keep = np.ones(len(looks), bool)
    keep[1:] = looks[1:] != looks[:-1]
    inner = chunk.at[1:-1]
    keep[inner[inner < len(keep)]] = True
    at = np.concatenate([[0], np.cumsum(keep)])[chunk.at]
    shape = words(Chunk(chunk.first, chunk.last, looks[keep], at), PLAIN, PLAIN_WORD)
    own = w.text_of()
    again = np.flatnonzero((w.hash[1:] == w.hash[:-1]) & (own[1:] == own[:-1]))
    kind = np.concatenate([shape.hash, np.zeros(len(again), np.uint64)])
    of = np.concatenate([shape.text_of(), own[again]])
    skey, count = np.unique(of.astype(np.uint64) << np.uint64(BITS) | (kind >> np.uint64(64 - BITS)), return_counts=True)
    stext = (skey >> np.uint64(BITS)).astype(np.int64)
    step = np.searchsorted(SHARES, count / np.maximum(np.diff(shape.at), 1)[stext])
    sfeature = (mix(skey & mask | step.astype(np.uint64) << np.uint64(BITS)) & mask).astype(np.int64) + (1 << BITS)

    text, feature = np.concatenate([text, stext]), np.concatenate([feature, sfeature])
    order = np.argsort(text, kind="stable")
    return text[order], feature[order]


def _scale(features_of: np.ndarray) -> np.ndarray:
    """What each feature of a text counts, by how many it has."""
    return np.minimum(1.0, np.sqrt(FEATURES / np.maximum(features_of, 1)))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Weights by feature, and the ordered thresholds between grades."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k from 1, one column each."""
        return _logistic(score[:, None] - self.thresholds[None, :])


def fit(text: np.ndarray, feature: np.ndarray, value: np.ndarray | float, grade: np.ndarray, grades: int, rounds: int = 300) -> Ordinal:
    """Least negative log-likelihood with ridges, by Adam; ``text`` numbers the rows of ``grade``."""
    size, n = 2 << BITS, len(grade)
    scale = _scale(np.bincount(text, minlength=n))
    seen = np.bincount(feature, minlength=size)
    apart = np.bincount(feature, (grade - grade.mean())[text], minlength=size) if n else np.zeros(size)
    used = np.flatnonzero(seen >= LEAST_TEXTS)
    number = np.full(size, -1, np.int32)
    number[used] = np.arange(len(used))
    place = number[feature]
    if len(used) < size:
        kept = place >= 0
        text, place, value = text[kept], place[kept], value if np.isscalar(value) else value[kept]
    errors = np.abs(apart[used]) / (np.sqrt(seen[used]) * max(float(grade.std()) if n else 1.0, 1e-9))
    ridge = DECAY * (1 + (ERRORS / np.maximum(errors, 1e-3)) ** 4) / max(n, 1)
    del seen, apart, number
    w = np.zeros(len(used))
    # Thresholds start at the grades' shares; gaps are exponentials, so their order holds.
    below = (np.cumsum(np.bincount(grade, minlength=grades))[:-1] + 0.5) / (n + 0.5 * grades) if n else np.arange(1, grades) / grades
    t = np.log(below / (1 - below))
    p = np.concatenate([w, t[:1], np.log(np.maximum(np.diff(t), 1e-3))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    for k in range(1, rounds * bool(n) + 1):
        w, first, gaps = p[: len(used)], p[len(used)], np.exp(p[len(used) + 1 :])
        t = np.concatenate([[first], first + np.cumsum(gaps)])
        s = scale * np.bincount(text, w[place] * value, minlength=n)
        edge = np.concatenate([[-np.inf], t, [np.inf]])
        up, low = _logistic(edge[grade + 1] - s), _logistic(edge[grade] - s)
        up[grade == grades - 1], low[grade == 0] = 1, 0
        chance = np.maximum(up - low, 1e-9)
        d_up, d_low = up * (1 - up) / chance, low * (1 - low) / chance
        pull = (d_up - d_low) / n  # of the loss by the score
        d_t = np.zeros(grades + 1)
        np.add.at(d_t, grade + 1, -d_up / n)
        np.add.at(d_t, grade, d_low / n)
        d_t = d_t[1:-1]
        later = np.cumsum(d_t[::-1])[::-1]
        g = np.concatenate([np.bincount(place, (pull * scale)[text] * value, minlength=len(used)), later[:1], later[1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.05 / (np.sqrt(v / (1 - 0.99**k)) + 1e-8)
        p -= step * m / (1 - 0.9**k)
        p[: len(used)] /= 1 + step[: len(used)] * ridge  # the ridge's own step, exact however steep it is
    weights = np.zeros(size, np.float32)
    weights[used] = p[: len(used)]
    first, gaps = p[len(used)], np.exp(p[len(used) + 1 :])
    return Ordinal(weights, np.concatenate([[first], first + np.cumsum(gaps)]))


def train(docs: DataFrame, ratings: DataFrame, grades: int, max_rows: int = 20_000) -> Ordinal:
    """A model from ``ratings`` (doc_id, grade 0..grades-1) of ``docs``; ``max_rows`` is also the
    bound of what is broadcast to find their texts and of what the driver gets."""
    usable = ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, grades - 1))
    picked = usable.select("doc_id", F.col("grade").cast("int").alias("grade")).orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_rows)
    picked = picked.withColumn("pick", F.monotonically_increasing_id())
    rated = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("pick", "grade", "text")
    # Copies of a rated row count once, and whatever else bears its id is bounded, too.
    rated = rated.withColumn("h", F.xxhash64("text")).dropDuplicates(["pick", "h"]).select("grade", "text").limit(max_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                text, feature = features(chunk)
                at = np.searchsorted(text, np.arange(len(chunk.at))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(chunk.first, chunk.last - chunk.first), pa.ListArray.from_arrays(at, feature.astype(np.int32))],
                    ["grade", "feature"],
                )

    got = rated.mapInArrow(run, "grade int, feature array<int>").toArrow()
    lists = got["feature"].combine_chunks()
    text = np.repeat(np.arange(len(got), dtype=np.int32), np.asarray(pa.compute.list_value_length(lists)))
    grade = np.asarray(got["grade"].combine_chunks(), np.int64)
    feature = np.asarray(lists.flatten())
    del got, lists
    return fit(text, feature, 1.0, grade, grades)


def grade(docs: DataFrame, model: Ordinal, name: str = "_tails") -> DataFrame:
    """All columns of ``docs``, and ``name``: P(grade >= k) for k from 1, as an array."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((model.weights, model.thresholds))
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.DoubleType()))])
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        own = Ordinal(*held.value)
        for batch in batches:
            tails = []
            for chunk in chunks(batch.column(where)):
                text, feature = features(chunk)
                n = len(chunk.at) - 1
                score = _scale(np.bincount(text, minlength=n)) * np.bincount(text, own.weights[feature], minlength=n)
                tails.append(own.tails(score))
            flat = np.concatenate(tails) if tails else np.zeros((0, len(own.thresholds)))
            lists = pa.ListArray.from_arrays(np.arange(0, flat.size + 1, flat.shape[1], dtype=np.int32), flat.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades of ``labels``: 0 toxic, 1 of low quality, 2 neither; null where either is unknown."""
    return labels.select("doc_id", F.expr("case when quality is null or toxic is null then null when toxic = 1 then 0 when quality = 0 then 1 else 2 end").alias("grade"))
