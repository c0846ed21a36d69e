"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased, everything but letters becomes a blank, and its byte pairs and triples are
hashed into ``BUCKETS`` rows of an embedding table. The mean of the rows goes through a linear
softmax. Both are trained together by stochastic gradient descent in numpy, on about ``SAMPLE``
documents of each language and ``SAMPLE_IN_ALL`` at most. A fifth of the sample is kept from training; on it a temperature and
a rejection threshold are calibrated: the ``REJECT`` quantile of the scores of rightly recognised texts,
at most one half. As everything is linear, the product of both tables is what scoring looks up.

Defined cases: a null text or one without any letter (``str.isalpha``: ½ and Ⅷ are none) is ``und`` with score 0 and rejected; without training
rows every text is ``und``; texts of any length are read whole; repeated rows are scored one by
one; other columns are not read.
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
from .base import release_memory, rows_where, slices, text_buffers, tidy
from .sampling import sample_by_class

BUCKETS = 1 << 15
WIDTH = 16
# Documents of each language that training may take (in expectation), and of all languages together.
SAMPLE, SAMPLE_IN_ALL = 1000, 50_000
EPOCHS = 8
REJECT = 0.001
UNKNOWN = "und"

# How features travel to the driver: a bucket is below 2^15.
_BUCKET, _SHARE = np.dtype("<u2"), np.dtype("<f4")

# Bytes of text times languages whose weights are looked up at once.
STEP = 1 << 22
_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


def _bytes(data: np.ndarray) -> np.ndarray:
    """Letters in lower case (Latin-1 capitals too), all else blank."""
    out = _PLAIN[data]
    if len(out) > 1:
        second = np.flatnonzero(out[:-1] == 0xC3) + 1
        capital = second[(out[second] >= 0x80) & (out[second] <= 0x9E) & (out[second] != 0x97)]
        out[capital] += 0x20
    return out


def subwords(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(n, bucket of the n bytes from each place on) for pairs and triples."""
    plain = _bytes(data).astype(np.uint32)
    for n in (2, 3):
        if len(plain) >= n:
            code = np.full(len(plain) - n + 1, n, np.uint32)
            for j in range(n):
                code = code * np.uint32(257) + plain[j : len(plain) - n + 1 + j]
            yield n, ((code * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


def sparse(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and their shares."""
    found = [b for _, b in subwords(np.frombuffer(text.encode(), np.uint8))]
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    buckets, counts = np.unique(np.concatenate(found), return_counts=True)
    return buckets.astype(np.int32), (counts / counts.sum()).astype(np.float32)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    threshold: float

    def logits(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Texts are taken in groups of ``STEP`` bytes by languages; a longer text is counted by bucket, slice by slice."""
        out = np.zeros((len(at) - 1, len(self.languages)))
        step = max(1 << 12, STEP // max(1, len(self.languages)))
        text = 0
        while text < len(out):
            end = max(text + 1, int(np.searchsorted(at, at[text] + step, "right")) - 1)
            if at[end] - at[text] > step:
                out[text] = self._long(data[at[text] : at[end]], step)
            else:
                out[text:end] = self._short(data[at[text] : at[end]], at[text : end + 1] - at[text])
            text = end
        return out + self.bias

    def _short(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.zeros((len(at) - 1, len(self.languages)))
        count = np.zeros(len(at) - 1)
        for n, bucket in subwords(data):
            first, last = at[:-1], at[1:] - n + 1
            own = np.flatnonzero(last > first)
            if len(own):
                edges = np.stack([first[own], last[own]], axis=1).reshape(-1)
                values = np.concatenate([self.weights[bucket], np.zeros((1, len(self.languages)))])
                total[own] += np.add.reduceat(values, edges, axis=0)[::2]
                count[own] += last[own] - first[own]
        return total / np.maximum(count, 1)[:, None]

    def _long(self, data: np.ndarray, step: int) -> np.ndarray:
        counts = np.zeros(BUCKETS, np.int64)
        for begin in range(0, len(data), step):
            # A byte before the slice tells whether its first one belongs to a capital, two behind complete its subwords.
            lead = min(begin, 1)
            for _, bucket in subwords(data[begin - lead : begin + step + 2]):
                counts += np.bincount(bucket[lead : lead + step], minlength=BUCKETS)
        return counts @ self.weights / max(1, int(counts.sum()))

    def scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        return _softmax(self.logits(data, at))

    def judge(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected of each text."""
        known = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts.to_pylist()], bool)
        if not self.languages:
            known[:] = False
        best, score = np.zeros(len(texts), int), np.zeros(len(texts))
        if known.any():
            scores = self.scores(*text_buffers(texts))
            best, score = scores.argmax(axis=1), np.where(known, scores.max(axis=1), 0.0)
        names = [self.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
        return names, score, ~known | (score < self.threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], seed: int = 7) -> Model:
    """Fit on (language, buckets, shares). The arrays may be of narrow types; they are widened one text at a time."""
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return Model((), np.zeros((BUCKETS, 0)), np.zeros(0), 0.0)
    draw = np.random.default_rng(seed)
    rows = [rows[i] for i in draw.permutation(len(rows))]
    kept = rows[: len(rows) // 5] if len(rows) >= 50 else rows
    own = rows[len(rows) // 5 :] if len(rows) >= 50 else rows
    label = {name: i for i, name in enumerate(languages)}
    table = draw.normal(0, 0.1, (BUCKETS, WIDTH))
    out, bias = np.zeros((WIDTH, len(languages))), np.zeros(len(languages))
    steps, step = EPOCHS * len(own), 0
    for _ in range(EPOCHS):
        for i in draw.permutation(len(own)):
            name, buckets, shares = own[i]
            rate = 2.0 * (1 - step / steps) + 0.02
            step += 1
            if not len(buckets):
                continue
            shares = shares.astype(np.float64)
            mean = shares @ table[buckets]
            error = _softmax(mean @ out + bias)
            error[label[name]] -= 1
            back = out @ error
            out -= rate * np.outer(mean, error)
            bias -= 0.05 * rate * error
            table[buckets] -= (10 * rate) * np.outer(shares, back)
    weights = table @ out
    truth = np.array([label[r[0]] for r in kept])
    z = np.array([(r[2].astype(np.float64) @ weights[r[1]] if len(r[1]) else 0) + bias for r in kept])
    loss = lambda t: -np.log(_softmax(z / t)[np.arange(len(kept)), truth] + 1e-12).mean()
    heat = min((0.7, 1.0, 1.4, 2.0, 3.0), key=loss)
    best = _softmax(z / heat)
    right = best.argmax(axis=1) == truth
    threshold = min(0.5, float(np.quantile(best.max(axis=1)[right], REJECT))) if right.any() else 0.0
    return Model(languages, weights / heat, bias / heat, threshold)


def fit(documents: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = SAMPLE) -> Model:
    """Train on the rows given (all of them may be learned from); about ``most`` for each language, ``SAMPLE_IN_ALL`` in all."""
    rows = documents.select(F.col(key).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    rows = sample_by_class(rows.filter("l is not null and t is not null"), "k", "l", most, SAMPLE_IN_ALL)

    def features(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [sparse(t) for t in frame["t"]]
            b, shares = ([m[0].astype(_BUCKET).tobytes() for m in made], [m[1].astype(_SHARE).tobytes() for m in made])
            yield pd.DataFrame({"k": frame["k"], "l": frame["l"], "b": b, "s": shares})

    # Features come as bytes, task by task, and are read where they lie: the driver holds each once.
    found = rows.mapInPandas(tidy(features), f"k {dict(rows.dtypes)['k']}, l string, b binary, s binary")
    came = sorted(cut_lineage(found).toLocalIterator(), key=lambda r: (r["l"], r["k"]))
    model = train([(r["l"], np.frombuffer(r["b"], _BUCKET), np.frombuffer(r["s"], _SHARE)) for r in came])
    del came
    release_memory()
    return model


def identify(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score, rejected for each row."""
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t", 1 << 20):
            names, score, rejected = model.judge(batch["t"])
            yield pa.RecordBatch.from_arrays(
                [batch["k"], pa.array(names, pa.string()), pa.array(score), pa.array(rejected)],
                ["k", "lang_pred", "score", "rejected"],
            )

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    out = rows.mapInArrow(tidy(run), f"k {kind}, lang_pred string, score double, rejected boolean")
    return out.withColumnRenamed("k", key)


def keep_identified(documents: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows, with all columns, whose language is not rejected."""
    return rows_where(documents, text, lambda texts: ~model.judge(texts)[2], 1 << 20)
