"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text.

Folding maps look-alike letters of other scripts, accents, digit and mark substitutions to one Latin
skeleton (``1``, ``l`` and ``i`` are one letter; marks count between word characters only), drops invisible characters, and turns everything
else into blanks. Entries are word beginnings of the skeleton, so that inflected and compounded
forms match; an entry with a final blank is a whole word. Hits inside an exception phrase do not count.

The lexicon is learned from labelled documents: word beginnings that are far more frequent in toxic ones are
candidates. Their evidence counts different neighbour words, not documents, so that what copies of one toxic document
share does not become an entry; it must exceed ``EVIDENCE`` nats, which chance does not reach among
millions of candidates. Of beginnings of each other the one with most weight and evidence stays.
An entry weighs its log odds. The score is logistic in the logarithm of the summed weights over a power of the number of
words; the power and the two coefficients are fitted on the same sample.

Learning takes about ``SAMPLE`` documents of each label, the lexicon at most ``ENTRIES`` candidates.

Defined cases: a null or empty text has no hit and the score of none; without labelled rows the lexicon is empty
and the score 0; texts are read whole; repeated rows are scored one by one; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import rows_where, slices, tidy
from .sampling import one_text, sampled_labels

SAMPLE = 3000
ENTRIES = 20_000
SUPPORT = 3
LEAST_ODDS = 2.5
EVIDENCE = 16.0
PREFIXES = range(4, 11)
EXCEPTIONS = ("trash can", "trash bin", "trash collection", "trash bag", "clown fish", "pond scum", "scum line")

# Letters of other scripts and marks that stand for Latin letters, as (what stands, for what).
HOMOGLYPHS = (
    ("а", "a"), ("А", "a"), ("α", "a"), ("Α", "a"), ("4", "a"),
    ("В", "b"), ("в", "b"), ("β", "b"), ("Β", "b"), ("8", "b"),
    ("с", "c"), ("С", "c"), ("ϲ", "c"),
    ("ԁ", "d"), ("ɗ", "d"),
    ("е", "e"), ("Е", "e"), ("ε", "e"), ("Ε", "e"), ("є", "e"), ("3", "e"),
    ("ɡ", "g"), ("9", "g"), ("6", "g"),
    ("һ", "h"), ("Н", "h"), ("Η", "h"),
    ("і", "i"), ("І", "i"), ("ι", "i"), ("Ι", "i"), ("ı", "i"), ("ӏ", "i"), ("1", "i"), ("l", "i"), ("L", "i"),
    ("ј", "j"), ("Ј", "j"),
    ("к", "k"), ("К", "k"), ("κ", "k"), ("Κ", "k"),
    ("м", "m"), ("М", "m"), ("Μ", "m"),
    ("п", "n"), ("Ν", "n"), ("ո", "n"),
    ("о", "o"), ("О", "o"), ("ο", "o"), ("Ο", "o"), ("σ", "o"), ("0", "o"),
    ("р", "p"), ("Р", "p"), ("ρ", "p"), ("Ρ", "p"),
    ("ѕ", "s"), ("Ѕ", "s"), ("5", "s"),
    ("т", "t"), ("Т", "t"), ("τ", "t"), ("Τ", "t"), ("7", "t"),
    ("υ", "u"), ("ս", "u"),
    ("ν", "v"), ("ѵ", "v"),
    ("ԝ", "w"), ("ω", "w"),
    ("х", "x"), ("Х", "x"), ("χ", "x"), ("Χ", "x"),
    ("у", "y"), ("У", "y"), ("γ", "y"), ("Υ", "y"),
    ("Ζ", "z"), ("2", "z"),
    ("ß", "ss"), ("æ", "ae"), ("Æ", "ae"), ("œ", "oe"), ("Œ", "oe"), ("ø", "o"), ("Ø", "o"), ("ł", "i"), ("Ł", "i"), ("đ", "d"),
)


# Marks that stand for letters inside a word, two of them also before one.
INNER_MARKS = {"@": "a", "!": "i", "|": "i", "$": "s", "+": "t"}
_INNER = re.compile(r"(?<=\w)[@!|$+](?=\w)|(?<!\S)[@$](?=\w)")


class Folding(dict):
    """A translation table that works out each character once."""

    def __init__(self):
        super().__init__({ord(a): b for a, b in HOMOGLYPHS})

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if unicodedata.category(char) in ("Cf", "Mn", "Me"):
            out = ""
        else:
            plain = unicodedata.normalize("NFKD", char).lower()
            kept = [c for c in plain if not unicodedata.combining(c)]
            out = "".join(dict.get(self, ord(c)) or (c if c.isalpha() else " ") for c in kept)
        self[code] = out
        return out


_FOLDING = Folding()


def fold_text(text: str | None) -> str:
    text = text or ""
    if any(mark in text for mark in INNER_MARKS):
        text = _INNER.sub(lambda found: INNER_MARKS[found[0]], text)
    return text.translate(_FOLDING)


def beginnings(words: set[str]) -> set[str]:
    """The candidate entries of a document's folded words."""
    out = {w + " " for w in words if 1 < len(w) < 4}
    for n in PREFIXES:
        out.update(w[:n] for w in words if len(w) >= n)
    return out


def neighbours_of(text: str | None, candidates) -> set[tuple[str, str]]:
    """(entry, word before it) for the candidates that a text holds."""
    words = fold_text(text).split()
    out = set()
    for before, word in zip(["", *words], words):
        out.update((entry, before) for entry in beginnings({word}) if entry in candidates)
    return out


@dataclass(frozen=True)
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    power: float = 0.5
    slope: float = 1.0
    bias: float = -700.0
    _machine: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "_machine": []}

    def machine(self):
        """The automaton, built once in each process."""
        if not self._machine:
            import ahocorasick

            own = ahocorasick.Automaton()
            for phrase in self.exceptions:
                folded = f" {fold_text(phrase)} "
                own.add_word(folded, (len(folded), None))
            for entry, weight in self.weights.items():
                own.add_word(" " + entry, (len(entry) + 1, weight))
            own.make_automaton()
            self._machine.append(own)
        return self._machine[0]

    def weigh(self, text: str | None) -> tuple[float, int]:
        """Summed weights of the hits that no exception covers, and the number of words. Of entries that
        begin at one place only the longest counts."""
        folded = f" {fold_text(text)} "
        n_words = len(folded.split())
        if not self.weights or not n_words:
            return 0.0, n_words
        hits: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.machine().iter(folded):
            if weight is None:
                spared.append((end - size + 1, end))
            else:
                hits[end - size + 1] = weight
        total = sum(w for at, w in hits.items() if not any(a <= at < b for a, b in spared))
        return total, n_words

    def level(self, total: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        return np.log1p(total / np.maximum(1.0, n_words / 100.0) ** self.power)

    def scores(self, total: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        z = self.slope * self.level(np.asarray(total, float), np.asarray(n_words, float)) + self.bias
        return np.where(z < -690, 0.0, 1 / (1 + np.exp(-np.clip(z, -690, 35))))


def choose(counts: dict[str, tuple[int, int, float]], neighbours: dict[str, set], share: float) -> dict[str, float]:
    """Entries and weights from (toxic, clean, odds) counts, the different words before an entry in toxic
    documents, and the share of toxic documents in the sample."""
    evidence: dict[str, float] = {}
    for entry, (_, clean, odds) in counts.items():
        seen = len(neighbours.get(entry, ()))
        if seen < SUPPORT:
            continue
        part = seen / (seen + clean)
        nats = seen * np.log(part / share) + (clean * np.log((1 - part) / (1 - share)) if clean else 0.0)
        if part > share and nats >= EVIDENCE:
            evidence[entry] = odds * seen
    chosen: dict[str, float] = {}
    for entry in sorted(evidence, key=lambda e: (-evidence[e], -len(e), e)):
        begun = any(entry[:n] in chosen for n in range(1, len(entry)))
        if not begun and not any(other.startswith(entry) for other in chosen):
            chosen[entry] = counts[entry][2]
    return chosen


def fit_curve(totals: np.ndarray, n_words: np.ndarray, truth: np.ndarray, weights: dict[str, float], exceptions) -> Lexicon:
    """Coefficients by Newton steps with a slight penalty, for the power that fits best."""
    best = None
    for power in (0.1, 0.25, 0.5, 0.75, 1.0):
        shape = Lexicon(weights, exceptions, power)
        x = np.stack([shape.level(totals, n_words), np.ones(len(truth))], axis=1)
        w = np.zeros(2)
        for _ in range(40):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
            grad = x.T @ (p - truth) + 0.02 * w
            hess = (x * (p * (1 - p))[:, None]).T @ x + 0.02 * np.eye(2)
            w -= np.linalg.solve(hess, grad)
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        loss = -np.mean(np.log(np.where(truth == 1, p, 1 - p) + 1e-12))
        if best is None or loss < best[0] - 1e-9:
            best = (loss, power, float(w[0]), float(w[1]))
    return Lexicon(weights, exceptions, *best[1:])


def fit(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id",
    most: int = SAMPLE, exceptions: tuple[str, ...] = EXCEPTIONS,
) -> Lexicon:
    """Learn the lexicon and the curve. All rows of ``labels`` may be learned from.

    The sampled ids (bounded by ``most``) are joined by broadcast; of the documents, only counts per candidate,
    the toxic documents' candidates and one number of hits and words a document reach the driver.
    """
    chosen = cut_lineage(sampled_labels(labels, label, key, most))
    sizes = {r["y"]: r["count"] for r in chosen.groupBy("y").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({}, exceptions)
    rows = cut_lineage(one_text(documents, chosen, key, "text"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            tally: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for text, y in zip(frame["t"], frame["y"]):
                for entry in beginnings(set(fold_text(text).split())):
                    tally[entry][y] += 1
            yield pd.DataFrame([(e, c[1], c[0]) for e, c in tally.items()], columns=["entry", "toxic", "clean"])

    def odds(toxic, clean):
        return F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))

    tallied = rows.mapInPandas(tidy(count), "entry string, toxic long, clean long").groupBy("entry")
    tallied = tallied.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    weighed = tallied.filter(F.col("toxic") >= SUPPORT).withColumn("odds", odds(F.col("toxic"), F.col("clean")))
    top = weighed.filter(F.col("odds") >= LEAST_ODDS).orderBy(F.desc(F.col("odds") * F.col("toxic")), "entry").limit(ENTRIES)
    candidates = {r["entry"]: (r["toxic"], r["clean"], r["odds"]) for r in top.collect()}

    def explain(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            pairs = {pair for text in frame["t"] for pair in neighbours_of(text, candidates)}
            yield pd.DataFrame(sorted(pairs), columns=["entry", "before"])

    found = rows.filter("y = 1").mapInPandas(tidy(explain), "entry string, before string").distinct()
    neighbours: dict[str, set] = defaultdict(set)
    for entry, before in found.toPandas().itertuples(index=False):
        neighbours[entry].add(before)
    weights = choose(candidates, neighbours, n_toxic / (n_toxic + n_clean))
    lexicon = Lexicon(weights, exceptions)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            weighed = [lexicon.weigh(t) for t in frame["t"]]
            yield pd.DataFrame({"y": frame["y"], "total": [w[0] for w in weighed], "n": [w[1] for w in weighed]})

    seen = rows.mapInPandas(tidy(measure), "y int, total double, n long").toPandas().sort_values(["y", "total", "n"])
    return fit_curve(seen["total"].to_numpy(), seen["n"].to_numpy(float), seen["y"].to_numpy(), weights, exceptions)


def keep_clean(documents: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows, with all columns, whose score is below the threshold."""

    def clean(texts: pa.Array) -> np.ndarray:
        weighed = [lexicon.weigh(t) for t in texts.to_pylist()]
        return lexicon.scores([w[0] for w in weighed], [w[1] for w in weighed]) < threshold

    return rows_where(documents, text, clean)


def score(documents: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score, predicted, n_words for each row."""
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            weighed = [lexicon.weigh(t) for t in batch["t"].to_pylist()]
            n_words = np.array([w[1] for w in weighed], np.int64)
            scores = lexicon.scores(np.array([w[0] for w in weighed]), n_words)
            yield pa.RecordBatch.from_arrays(
                [batch["k"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32)), pa.array(n_words)],
                ["k", "score", "predicted", "n_words"],
            )

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(tidy(run), f"k {kind}, score double, predicted int, n_words long").withColumnRenamed("k", key)
