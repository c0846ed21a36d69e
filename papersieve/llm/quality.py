"""Quality classifier: hashed word n-grams and logistic regression by follow-the-regularised-leader.

A text is split into runs of letters, of digits and of other marks. Each run is two words: the run in
lower case and its shape (case pattern, kind of mark, same as the run before). Features are single
words and pairs of the first kind, and one to three successive words of the second kind, hashed into
``BUCKETS``; a feature's value is its share among those of its kind. The weights come from FTRL-proximal
updates, row by row, on about ``SAMPLE`` labelled documents of each label, reweighted to the labels'
true shares; scoring is a sparse dot product: weights looked up and averaged.

Defined cases: a null or empty text gets the score of the bias; without training rows the score is 0.5;
texts are read whole; repeated rows are scored one by one; rows whose label is null are not
learned from; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import slices, text_buffers, tidy
from .hashing import LOWER, mix, word_hashes
from .sampling import one_text, sampled_labels

BUCKETS = 1 << 16
# Labelled documents of each label that training may take (in expectation).
SAMPLE = 3000
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 2e-4, 1e-4

_BLANK, _LETTERS, _DIGITS, _MARKS = range(4)
_KIND = np.full(256, _MARKS, np.uint8)
_KIND[[0x20, *range(0x00, 0x20)]] = _BLANK
_KIND[ord("0") : ord("9") + 1] = _DIGITS
_KIND[ord("A") : ord("Z") + 1] = _LETTERS
_KIND[ord("a") : ord("z") + 1] = _LETTERS
_KIND[0x80:] = _LETTERS
_CAPITAL = np.zeros(256, np.int64)
_CAPITAL[ord("A") : ord("Z") + 1] = 1
_SMALL = np.zeros(256, np.int64)
_SMALL[ord("a") : ord("z") + 1] = 1


def runs(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of one kind, and the first run of each text."""
    if len(data) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    kind = _KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[at[:-1][at[:-1] < len(data)]] = True
    starts = np.flatnonzero(change)
    ends = np.append(starts[1:], len(data))
    solid = kind[starts] != _BLANK
    starts, ends = starts[solid], ends[solid]
    return starts, ends, np.searchsorted(starts, at)


def words_of(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hashed run and the hashed shape of each run."""
    lexical = word_hashes(LOWER[data], starts, ends)
    if not len(starts):
        return lexical, lexical
    sums = lambda flags: np.add.reduceat(np.append(flags[data], 0), np.stack([starts, ends], 1).reshape(-1))[::2]
    capitals, smalls = sums(_CAPITAL), sums(_SMALL)
    kind = _KIND[data[starts]].astype(np.uint64)
    case = np.where(capitals == 0, 0, np.where(smalls == 0, np.where(capitals > 1, 3, 2), 1)).astype(np.uint64)
    size = np.minimum(ends - starts, 4).astype(np.uint64)
    same = np.zeros(len(starts), np.uint64)
    same[1:] = lexical[1:] == lexical[:-1]
    same[first[:-1][first[:-1] < len(starts)]] = 0
    mark = np.where(kind == _MARKS, data[starts], 0).astype(np.uint64)
    letters = np.where(kind == _LETTERS, case, size)
    return lexical, mix(kind | letters << np.uint64(4) | same << np.uint64(8) | mark << np.uint64(12))


def features(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(words in the feature, first run of each text, bucket of the feature from each run on)."""
    starts, ends, first = runs(data, at)
    for salt, (symbols, longest) in enumerate(zip(words_of(data, starts, ends, first), (2, 3))):
        for n in range(1, longest + 1):
            if len(symbols) < n:
                continue
            code = np.full(len(symbols) - n + 1, 16 * salt + n, np.uint64)
            for j in range(n):
                code = code * np.uint64(0x100000001B3) + symbols[j : len(symbols) - n + 1 + j]
            yield n, first, (mix(code) >> np.uint64(48)).astype(np.int64)


def sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer((text or "").encode(), np.uint8)
    buckets, values = [], []
    for _, _, bucket in features(data, np.array([0, len(data)])):
        own, counts = np.unique(bucket, return_counts=True)
        buckets.append(own)
        values.append(counts / len(bucket))
    if not buckets:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    own, place = np.unique(np.concatenate(buckets), return_inverse=True)
    return own.astype(np.int32), np.bincount(place, np.concatenate(values)).astype(np.float32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.full(len(at) - 1, self.bias)
        for n, first, bucket in features(data, at):
            begin, end = first[:-1], first[1:] - n + 1
            own = np.flatnonzero(end > begin)
            if len(own):
                edges = np.stack([begin[own], end[own]], axis=1).reshape(-1)
                sums = np.add.reduceat(np.append(self.weights[bucket], 0.0), edges)[::2]
                total[own] += sums / (end[own] - begin[own])
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], share: float | None = None, seed: int = 7) -> Model:
    """FTRL-proximal over (label, buckets, values); ``share`` is the true share of label 1."""
    if not rows:
        return Model(np.zeros(BUCKETS), 0.0)
    own_share = np.mean([r[0] for r in rows])
    share = own_share if share is None else share
    weight = {1: share / own_share if own_share else 1.0, 0: (1 - share) / (1 - own_share) if own_share < 1 else 1.0}
    z, n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    draw = np.random.default_rng(seed)

    def current(at: np.ndarray) -> np.ndarray:
        shrunk = np.sign(z[at]) * L1 - z[at]
        return np.where(np.abs(z[at]) <= L1, 0.0, shrunk / ((BETA + np.sqrt(n[at])) / ALPHA + L2))

    for _ in range(EPOCHS):
        for i in draw.permutation(len(rows)):
            label, buckets, values = rows[i]
            at, x = np.append(buckets, BUCKETS), np.append(values, 0.3)
            w = current(at)
            error = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * weight[label]
            gradient = error * x
            sigma = (np.sqrt(n[at] + gradient**2) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - sigma * w
            n[at] += gradient**2
    w = current(np.arange(BUCKETS + 1))
    return Model(w[:-1], 0.3 * float(w[-1]))


def fit(documents: DataFrame, labels: DataFrame, label: str = "quality", key: str = "doc_id", most: int = SAMPLE) -> Model:
    """Train on labelled documents, about ``most`` for each label. All rows of ``labels`` may be learned from.

    The sampled ids are joined by broadcast: ``most`` bounds them.
    """
    marked = labels.select(F.col(label).cast("int").alias("y")).filter(f"y in (0, 1) and {key} is not null")
    counts = {r["y"]: r["count"] for r in marked.groupBy("y").count().collect()}
    rows = one_text(documents, cut_lineage(sampled_labels(labels, label, key, most)), key, "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [sparse(t) for t in frame["t"]]
            yield pd.DataFrame({"k": frame["k"], "y": frame["y"], "b": [m[0] for m in made], "v": [m[1] for m in made]})

    found = rows.mapInPandas(tidy(run), f"k {dict(rows.dtypes)['k']}, y int, b array<int>, v array<float>").toPandas()
    found = found.sort_values(["k", "y"])
    data = [(int(r.y), np.asarray(r.b, np.int64), np.asarray(r.v, np.float64)) for r in found.itertuples()]
    return train(data, counts.get(1, 0) / max(1, sum(counts.values())))


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, predicted for each row."""
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", 1 << 20):
            scores = model.scores(*text_buffers(batch["t"]))
            yield pa.RecordBatch.from_arrays(
                [batch["k"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))], ["k", "score", "predicted"]
            )

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(tidy(run), f"k {kind}, score double, predicted int").withColumnRenamed("k", key)
