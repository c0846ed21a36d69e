"""Words and their 64-bit hashes over whole batches of UTF-8 texts, without a loop over words."""

from __future__ import annotations

import numpy as np

# A word separator of the shingle contracts: space and the ASCII control blanks.
BLANKS = np.zeros(256, bool)
BLANKS[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_NEAR = 64  # positions in a word whose byte hashes are tabulated


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection whose output bits all depend on all input bits."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_GOLD = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _TABLE = mix((np.arange(_NEAR * 256, dtype=np.uint64) + np.uint64(1)) * _GOLD)


def words(data: np.ndarray, at: np.ndarray, blank: np.ndarray = BLANKS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the first word of each text (one more than texts)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(at), np.int64)
    inside = ~blank[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    first = at[:-1][at[:-1] < n]
    begins[first] = inside[first]
    last = at[1:][at[1:] > 0] - 1
    ends[last] = inside[last]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Each word's hash: the mixed sum of one random value for each (position, byte)."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(int(size.sum()), dtype=np.int64) - np.repeat(first, size)
    byte = data[place + np.repeat(starts, size)]
    key = (place << 8) | byte
    if int(size.max()) <= _NEAR:
        value = _TABLE[key]
    else:
        near = place < _NEAR
        value = np.empty(len(key), np.uint64)
        value[near] = _TABLE[key[near]]
        with np.errstate(over="ignore"):
            value[~near] = mix((key[~near].astype(np.uint64) + np.uint64(1)) * _GOLD)
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(value, first) + size.astype(np.uint64) * _GOLD)


def gram_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, for each word that n - 1 words follow in the array."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(n):
            out += mix(hashes[j : len(hashes) - n + 1 + j] + np.uint64(j + 1) * _GOLD)
    return mix(out)
