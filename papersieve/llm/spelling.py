"""Spelling variants: words one edit apart, found through a reduced alphabet.

1. Count the words of all texts; those with enough letters and occurrences are the vocabulary.
2. Reduce each word: a hash of every code point gives one of ``SYMBOLS`` symbols. Words one edit apart have reduced words that
   are equal or one edit apart.
3. Generate the whole neighbourhood of each reduced word: itself, every replaced, deleted and inserted symbol, each distinct string
   once. It has about 2 * length * SYMBOLS strings, where the full alphabet would need twelve times as many. Strings are told by 64-bit sums
   of one random number for each (place, symbol), so a whole neighbourhood takes a few additions per string in numpy.
   A Bloom filter of the reduced vocabulary, of ``MOST_BITS`` bits at most, is sent to all tasks; strings that it does not know are no word and
   are not passed on. It only spares rows: where it is full, more strings are passed on.
4. Join the neighbourhoods with the reduced vocabulary and keep pairs whose original words differ by exactly one edit; this test is part
   of the join, so pairs that meet only in the reduced alphabet leave no rows.
5. A word's form is its most frequent near word, if that is ``RATIO`` times as frequent; its root is the end of the forms. As
   each form is ``RATIO`` times as frequent as the one before, chains are short, and doubling the steps ends after a few joins.

Both sides of the join are shuffled by the string's number, at every size. Words are counted per task before any shuffle. No word's neighbours are gathered: counts and the
best form are partial aggregates.

Defined cases: null, empty and blank texts have no word; a null key counts as an empty string where words are damaged; repeated rows count
again; ties for the form go to the smallest word in code-point order; an empty table gives no row; words of any length are
taken whole; other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import tidy
from .hashing import mix

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
SYMBOLS = 8
# Bits of the filter for each word, and in all.
WORD_BITS, MOST_BITS = 32, 1 << 28
# Bits of the filter that a task returns as one row.
_PIECE = 1 << 22
# Strings that a task makes at once.
_MADE = 1 << 18


def letter_runs(documents: DataFrame, least: int = LEAST_LENGTH, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key as text, word) for each maximal run of at least ``least`` letters, A to Z in lower case."""
    lower = F.translate(F.col(text).cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    runs = F.regexp_extract_all(lower, F.lit(f"[a-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0))
    return documents.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.explode(runs).alias("word"))


def damaged(runs: DataFrame, every: int = 31) -> DataFrame:
    """(word): the runs, where one in ``every``, told by the crc32 h of ``key:word``, lacks its code point h % length (from 0)."""
    h = F.crc32(F.concat_ws(":", "key", "word"))
    rows = runs.select("word", h.alias("h"))
    at = (F.col("h") % F.length("word")).cast("int")
    rest = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return rows.select(F.when(F.col("h") % every == 0, rest).otherwise(F.col("word")).alias("word"))


def vocabulary(words: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.filter(F.length("word") >= least_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= least_count)


def _values(symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The random number for symbols at places."""
    return mix(place.astype(np.uint64) * np.uint64(64) + symbol.astype(np.uint64) + np.uint64(1))


def reduce(words: list[str]) -> np.ndarray:
    """The symbols of words of one length, a row each."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)
    return (mix(points) % np.uint64(SYMBOLS)).astype(np.int64)


def reduced_key(symbols: np.ndarray) -> np.ndarray:
    places = np.arange(symbols.shape[1])
    return _values(symbols, places[None, :]).sum(axis=1, dtype=np.uint64)


def neighbourhood(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word, key): the number of each string at most one edit away from reduced words of one length, each string once."""
    m, n = symbols.shape
    every, place = np.arange(SYMBOLS), np.arange(n)
    moved = [_values(symbols, place[None, :] + d) for d in (-1, 0, 1)]
    before = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(moved[1], axis=1, dtype=np.uint64)], axis=1)
    total = before[:, -1]

    def behind(values: np.ndarray) -> np.ndarray:
        """Sums of the values from each place on, and 0 at the end."""
        sums = np.cumsum(values[:, ::-1], axis=1, dtype=np.uint64)[:, ::-1]
        return np.concatenate([sums, np.zeros((m, 1), np.uint64)], axis=1)

    words, keys = [np.arange(m)], [total]

    def take(made: np.ndarray, wanted: np.ndarray) -> None:
        words.append(np.nonzero(wanted)[0])
        keys.append(made[wanted])

    with np.errstate(over="ignore"):
        new = _values(every[None, :], place[:, None])
        take((total[:, None] - moved[1])[:, :, None] + new[None], symbols[:, :, None] != every)
        # Deleting any symbol of a stretch of equal ones, or inserting one more of them anywhere in it, gives one string.
        other = np.ones((m, n), bool)
        other[:, 1:] = symbols[:, 1:] != symbols[:, :-1]
        if n > 1:
            take(before[:, :-1] + behind(moved[0])[:, 1:], other)
        new = _values(every[None, :], np.arange(n + 1)[:, None])
        differs = np.ones((m, n + 1, SYMBOLS), bool)
        differs[:, 1:] = symbols[:, :, None] != every
        take((before + behind(moved[2]))[:, :, None] + new[None], differs)
    return np.concatenate(words), np.concatenate(keys)


def _by_length(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    """Rows of a batch with words of one length, as many as give about ``_MADE`` strings."""
    lengths = np.array([len(w) for w in batch["word"].to_pylist()])
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        step = max(1, _MADE // (2 * int(n) * SYMBOLS))
        for at in range(0, len(own), step):
            yield own[at : at + step]


def _mapped(rows: DataFrame, schema: str, keys) -> DataFrame:
    """Each row (word, n) repeated with every key that ``keys`` gives for its reduced word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for own in _by_length(batch):
                part = batch.take(pa.array(own))
                row, key = keys(reduce(part["word"].to_pylist()))
                part = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), part["word"], part["n"]], ["key", "a", "b"])

    return rows.select("word", "n").mapInArrow(tidy(run), schema)


def key_filter(keys: DataFrame, count: int) -> np.ndarray:
    """A Bloom filter with two bits for each ``key``, as 64-bit words. Tasks fill it piece by piece."""
    bits = 1 << 16
    while bits < min(MOST_BITS, WORD_BITS * count):
        bits *= 2
    piece = min(bits, _PIECE)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch["at"].to_numpy()
            for number in np.unique(at // piece).tolist():
                own = pieces.setdefault(number, np.zeros(piece // 8, np.uint8))
                place = at[at // piece == number] % piece
                np.bitwise_or.at(own, place >> 3, (1 << (place & 7)).astype(np.uint8))
        yield pa.RecordBatch.from_pydict({"number": pa.array(list(pieces), pa.int64()), "bits": [p.tobytes() for p in pieces.values()]})

    places = [f"key & {bits - 1}L", f"shiftrightunsigned(key, 32) & {bits - 1}L"]
    at = keys.select(F.explode(F.array(*map(F.expr, places))).alias("at"))
    filled = at.repartition(bits // piece, F.expr(f"at div {piece}")).mapInArrow(tidy(fill), "number bigint, bits binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in filled.toLocalIterator():
        out[row["number"] * (piece // 8) : (row["number"] + 1) * (piece // 8)] = np.frombuffer(row["bits"], np.uint8)
    return out.view(np.uint64)


def passes(known: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys a filter may hold."""
    mask, out = np.uint64(64 * len(known) - 1), np.ones(len(keys), bool)
    for at in (keys & mask, (keys >> np.uint64(32)) & mask):
        out &= (known[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)
    return out


def near_pairs(vocabulary: DataFrame) -> DataFrame:
    """(word, n, near, near_n): each word with each word one edit away from it."""
    held = _mapped(vocabulary, "key bigint, near string, near_n bigint", lambda s: (np.arange(len(s)), reduced_key(s)))
    held = cut_lineage(held)
    known = vocabulary.sparkSession.sparkContext.broadcast(key_filter(held.select("key"), held.count()))

    def known_neighbours(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, keys = neighbourhood(symbols)
        kept = passes(known.value, keys)
        return words[kept], keys[kept]

    made = cut_lineage(_mapped(vocabulary, "key bigint, word string, n bigint", known_neighbours))
    known.destroy()
    one_edit = (F.col("word") != F.col("near")) & (F.levenshtein("word", "near", 1) == 1)
    return made.join(held.hint("merge"), (made["key"] == held["key"]) & one_edit).select("word", "n", "near", "near_n")


def forms(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, form, form_n, n_near) of the words that have near words; form and form_n are null if none is frequent enough."""
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    found = near_pairs(vocabulary).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    enough = -F.col("best.less") >= ratio * F.col("n")
    return found.select(
        "word", "n", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"), "n_near"
    )


def roots(found: DataFrame, most: int, ratio: int = RATIO) -> DataFrame:
    """(word, root) of the words that have a form. ``most``: the largest n of any word."""
    at = cut_lineage(found.filter("form is not null").select("word", F.col("form").alias("root")))
    steps, longest = 1, 1
    while ratio**longest < most:
        longest += 1
    while steps < longest:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = cut_lineage(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
        steps *= 2
    return at


def group(vocabulary: DataFrame, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for each word of the vocabulary (word, n)."""
    vocabulary = cut_lineage(vocabulary)
    most = vocabulary.agg(F.max("n").alias("n")).first()["n"] or 0
    found = cut_lineage(forms(vocabulary, ratio))
    ends = roots(found, most, ratio)
    rows = vocabulary.join(found.drop("n"), "word", "left").join(ends, "word", "left")
    root = F.coalesce("root", "word").alias("root")
    return rows.select("word", "form", root, "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
