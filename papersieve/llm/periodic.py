"""Runs of periodic words in texts, by Kruskal over suffix classes in the order of falling LCP.

A run is a stretch of words with smallest period q, at least ``exponent`` * q and at least ``least`` words long, that no
neighbouring word extends with the same period. For each text:

1. Texts in which no stretch of ``least_lcp`` words occurs twice have no run and are done (a run of period q holds two
   occurrences, q apart, of its first length - q words, and the shortest such stretch has ``least_lcp`` words).
2. The suffixes of the others are sorted by prefix doubling; only groups that are not yet told apart are sorted again. The longest common
   prefix (LCP) of neighbours is compared word by word at the head of each chain of neighbours that go on side by side, and
   falls by one along the chain.
3. Neighbours are united with a union-find structure by falling LCP. A class keeps its positions in order; the smaller class goes
   into the larger one. Two positions i < j that become adjacent have a common prefix of exactly the LCP of the union. Where
   j - i is at most LCP / (exponent - 1) they seed the run from i to j + LCP with period j - i, unless the words before
   i and j are equal, in which case the run begins further left and has its own seed. The period is the
   smallest: a smaller one would put a position between i and j into the class.

Words are the stretches between ASCII blanks (space, \\x09 to \\x0D), compared by 64-bit hashes. Memory follows the longest
single text; texts are taken in slices of about a megabyte otherwise, each in its own task, without any shuffle.

Defined cases: null, empty and blank texts have no word, no run and an empty collapsed text; overlapping runs are all returned,
and a word goes if any of them repeats it; texts of any length are read whole; repeated rows are read one by one; a null key
stays null; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import slices, text_buffers, tidy
from .hashing import mix, word_hashes, words

LEAST, EXPONENT = 24, 3
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
# Words that one step of a comparison may look at.
_COMPARED = 1 << 20


def least_lcp(least: int = LEAST, exponent: int = EXPONENT) -> int:
    """The shortest common prefix of two suffixes that may seed a run."""
    return min(max(least - q, (exponent - 1) * q) for q in range(1, least + 1))


def _grams(codes: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` codes from each place on, put together from stretches of powers of two."""
    out, have, level, width = None, 0, codes, 1
    while True:
        if size & width:
            n = len(codes) - have - width + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            part = level[have : have + n]
            out = part[:n] if out is None else mix(out[:n] * np.uint64(0x9E3779B97F4A7C15) + part)
            have += width
        if have == size:
            return out
        level = mix(level[: max(0, len(level) - width)] * np.uint64(0xD1342543DE82EF95) + level[width:])
        width *= 2


def repeating(codes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which texts hold a stretch of ``size`` words twice, and the hash of the stretch from each word on.

    ``first``: where each text's words begin, with the end. Stretches that run over the end of a text count as none.
    """
    texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = _grams(codes, size)
    own = np.flatnonzero(first[texts + 1][: len(grams)] - np.arange(len(grams)) >= size)
    keys = np.sort(mix(grams[own] ^ mix(texts[own].astype(np.uint64))))
    twice = np.zeros(len(first) - 1, bool)
    same = keys[1:][keys[1:] == keys[:-1]]
    if len(same):
        found = np.isin(mix(grams[own] ^ mix(texts[own].astype(np.uint64))), same)
        twice[texts[own[found]]] = True
    return twice, grams


def suffix_order(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The suffixes of all texts, ordered by text, then word by word; a suffix that ends comes first."""
    n = len(codes)
    ends = np.repeat(first[1:], np.diff(first))
    texts = np.repeat(np.arange(len(first) - 1), np.diff(first))
    _, code = np.unique(codes, return_inverse=True)
    key = texts * np.int64(n + 1) + code
    active, rank, h = np.arange(n), np.zeros(n, np.int64), 0
    old = np.zeros(n, np.int64)
    while len(active):
        if h:
            after = active + h
            there = after < ends[active]
            key = old * np.int64(n + 2) + np.where(there, rank[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        active, key, old = active[order], key[order], old[order]
        new_group = np.append(True, key[1:] != key[:-1])
        old_group = np.append(True, old[1:] != old[:-1])
        place = np.arange(len(active))
        begin = lambda marks: np.maximum.accumulate(np.where(marks, place, 0))  # noqa: B023, E731
        old = old + begin(new_group) - begin(old_group)
        rank[active] = old
        sizes = np.diff(np.append(np.flatnonzero(new_group), len(active)))
        more = np.repeat(sizes > 1, sizes)
        active, old = active[more], old[more]
        h = max(1, 2 * h)
    out = np.empty(n, np.int64)
    out[rank] = np.arange(n)
    return out


def common_prefixes(codes: np.ndarray, i: np.ndarray, j: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The length of the common prefix of the suffixes at i and j; none reaches ``end``."""
    out = np.zeros(len(i), np.int64)
    room = end - np.maximum(i, j)
    alive, width = np.arange(len(i)), 32
    while len(alive):
        going = []
        step = max(1, _COMPARED // width)
        for at in range(0, len(alive), step):
            part = alive[at : at + step]
            ahead = out[part][:, None] + np.arange(width)
            inside = ahead < room[part][:, None]
            x = codes[np.where(inside, i[part][:, None] + ahead, 0)]
            y = codes[np.where(inside, j[part][:, None] + ahead, 0)]
            same = inside & (x == y)
            whole = same.all(axis=1)
            out[part] += np.where(whole, width, same.argmin(axis=1))
            going.append(part[whole])
        alive, width = np.concatenate(going), min(2 * width, 1 << 16)
    return out


def neighbours(codes: np.ndarray, first: np.ndarray, grams: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(LCP, position, position) of neighbours in suffix order that share at least ``size`` words."""
    n = len(codes)
    ends = np.repeat(first[1:], np.diff(first))
    order = suffix_order(codes, first)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    hashes = np.zeros(n, np.uint64)
    hashes[: len(grams)] = grams
    fits = ends - np.arange(n) >= size
    at = np.maximum(before, 0)
    near = (before >= 0) & (ends[at] == ends) & fits & fits[at] & (hashes[at] == hashes)
    goes_on = np.zeros(n, bool)
    goes_on[1:] = near[1:] & near[:-1] & (before[1:] == before[:-1] + 1)
    heads = np.flatnonzero(near & ~goes_on)
    if len(heads) == 0:
        return heads, heads, heads
    lcp = common_prefixes(codes, heads, before[heads], ends[heads])
    b = np.flatnonzero(near)
    chain = np.searchsorted(heads, b, "right") - 1
    length = lcp[chain] - (b - heads[chain])
    kept = length >= size
    return length[kept], before[b[kept]], b[kept]


def _seeds(edges: tuple[np.ndarray, np.ndarray, np.ndarray], least: int, exponent: int) -> Iterator[tuple[int, int, int]]:
    """(i, j, LCP) of positions that become adjacent and lie near enough for a run."""
    order = np.argsort(-edges[0], kind="stable")
    parent: dict[int, int] = {}
    members: dict[int, list[int]] = {}

    def root(x: int) -> int:
        top = parent.get(x, x)
        while (above := parent.get(top, top)) != top:
            parent[x] = above
            x, top = top, above
        return top

    for lcp, a, b in zip(*(e[order].tolist() for e in edges)):
        a, b = root(a), root(b)
        large, small = members.pop(a, None) or [a], members.pop(b, None) or [b]
        if len(large) < len(small):
            large, small, a, b = small, large, b, a
        parent[b] = a
        members[a] = large
        for x in small:
            insort(large, x)
        own = set(small) if len(small) > 1 else ()
        for x in small:
            k = bisect_left(large, x)
            pairs = []
            if k and large[k - 1] not in own:
                pairs.append((large[k - 1], x))
            if k + 1 < len(large) and large[k + 1] not in own:
                pairs.append((x, large[k + 1]))
            for i, j in pairs:
                if (exponent - 1) * (j - i) <= lcp and j - i + lcp >= least:
                    yield i, j, lcp


def runs_of(codes: np.ndarray, first: np.ndarray, least: int = LEAST, exponent: int = EXPONENT) -> dict[int, list[tuple[int, int, int]]]:
    """The runs (start, length, period), by start and period, of each text that has any.

    ``codes``: 64-bit hashes of the words of all texts; ``first``: where each text's words begin, with the end.
    """
    size = least_lcp(least, exponent)
    if len(codes) < size:
        return {}
    twice, _ = repeating(codes, first, size)
    chosen = np.flatnonzero(twice)
    if len(chosen) == 0:
        return {}
    own = np.concatenate([codes[first[t] : first[t + 1]] for t in chosen])
    starts = np.concatenate([[0], np.cumsum(np.diff(first)[chosen])])
    found: dict[int, list[tuple[int, int, int]]] = {}
    for i, j, lcp in _seeds(neighbours(own, starts, _grams(own, size), size), least, exponent):
        text = int(np.searchsorted(starts, i, "right")) - 1
        begin = int(starts[text])
        if i == begin or own[i - 1] != own[j - 1]:
            found.setdefault(int(chosen[text]), []).append((i - begin, j - i + lcp, j - i))
    return {text: sorted(runs, key=lambda r: (r[0], r[2])) for text, runs in found.items()}


def kept_words(count: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which words stay when every run is cut to its first period."""
    kept = np.ones(count, bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return kept


def collapse(documents: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """key, n_words, runs (start, length and period in words, by start and period) and collapsed for each row.

    collapsed: the words of the text without what any run repeats, joined by one space.
    """
    kind = dict(documents.dtypes)[key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "t"):
            data, at = text_buffers(batch["t"])
            starts, ends, first = words(data, at)
            found = runs_of(word_hashes(data, starts, ends), first, least, exponent)
            raw, texts, runs = data.tobytes(), [], []
            for i in range(batch.num_rows):
                own = raw[at[i] : at[i + 1]].split()
                if i in found:
                    kept = kept_words(len(own), found[i])
                    own = [w for w, k in zip(own, kept.tolist()) if k]
                texts.append(b" ".join(own))
                runs.append([dict(zip(("start", "length", "period"), r)) for r in found.get(i, ())])
            yield pa.RecordBatch.from_arrays(
                [batch["k"], pa.array(np.diff(first)), pa.array(runs, _RUNS), pa.array(texts, pa.binary()).cast(pa.string())],
                ["k", "n_words", "runs", "collapsed"],
            )

    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.mapInArrow(tidy(run), f"k {kind}, n_words bigint, runs {RUNS}, collapsed string").withColumnRenamed("k", key)


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; ties: smallest start, then smallest period (null: no run)."""
    better = lambda x, y: (
        (x["length"] * y["period"] > y["length"] * x["period"])
        | (
            (x["length"] * y["period"] == y["length"] * x["period"])
            & ((x["start"] < y["start"]) | ((x["start"] == y["start"]) & (x["period"] < y["period"])))
        )
    )
    return F.reduce(runs, F.get(runs, F.lit(0)), lambda best, r: F.when(better(r, best), r).otherwise(best))


def planted(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text, where one text in ten, told by a hash of the key, goes on periodically from some word on.

    With h the crc32 of the key in decimal and g = h / 10 in whole numbers: if 10 divides h and the text has n > 0 words, word i >= a
    becomes word a + (i - a) % p, where a = g % n and p = 1 + (n - a) / (3 + g % 8) in whole numbers. Such a text has single spaces.
    """
    h = F.crc32(F.col(key).cast("string"))
    rows = documents.select(F.col(key), F.col(text).cast("string").alias(text), h.alias("_h"))
    word = F.regexp_extract_all(F.col(text), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = rows.withColumn("_w", F.when(F.col("_h") % 10 == 0, word))
    n, g = F.size("_w"), F.floor(F.col("_h") / 10)
    rows = rows.withColumn("_n", n).withColumn("_a", F.when(n > 0, g % n).cast("int"))
    rows = rows.withColumn("_p", (1 + F.floor((F.col("_n") - F.col("_a")) / (3 + g % 8))).cast("int"))
    period = F.slice("_w", F.col("_a") + 1, F.col("_p"))
    tail = F.flatten(F.array_repeat(period, F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int")))
    whole = F.slice(F.concat(F.slice("_w", F.lit(1), F.col("_a")), tail), F.lit(1), F.col("_n"))
    return rows.select(key, F.when(F.col("_n") > 0, F.array_join(whole, " ")).otherwise(F.col(text)).alias(text))
