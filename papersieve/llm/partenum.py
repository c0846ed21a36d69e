"""Signatures of sets for a Jaccard join (partition and enumerate).

The domain of features, 64-bit hashes, is cut into groups of ``SECOND`` parts each. Two sets with
Jaccard similarity of at least 4/5 and sizes a and b differ in at most h = (a + b) / 9 features. A group in
which they differ in at most one feature has ``SECOND - 1`` parts on which they agree, so the
sets share the signature of that subset of its parts. All subsets are enumerated.

Only features that are there make a signature, so empty parts need care. Count a group of a set as 2 if at
least two of its parts have features, as 1 if one has, else as 0. Go through the groups in order up to the first one that
agrees on a subset with features. Each group counted before it is one where the sets differ:
in two features at least if it counts 2, in one at least if it counts 1. So the counts before it sum up to h at most, in
either set: a set needs to sign only its first groups, until their counts exceed h.

A set whose counts never exceed h signs under the next of ``SCHEMES`` independent cuts as well; a pair that one cut
misses is thus met in the next one. The last cut also signs empty subsets of such sets. As sets differ in no more
features of a part of the domain than in all, the first cut leaves out features that very many documents hold
(a list that all tasks share): unlike documents with a passage in common then seldom share a signature. The number of groups depends on
the size band, and a set signs in each band that a partner's size may fall in: bands of ratio 25/16, own and next.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np

from .hashing import mix

SECOND = 2
SCHEMES = 6
_BAND = (25, 16)


@lru_cache(maxsize=1)
def band_tops() -> np.ndarray:
    tops, top = [], 1
    while top < 1 << 40:
        tops.append(top)
        top = max(top + 1, top * _BAND[0] // _BAND[1])
    return np.array(tops)


def most_different(size: int, top: int) -> int:
    """How many features a set can differ in from a linked partner not larger than ``top``."""
    return (size + min(size * 5 // 4, top)) // 9


def group_count(top: int) -> int:
    """Groups of a band: enough that the counts of nearly all sets exceed what they may differ in."""
    need = 2 * top // 9 // 2 + 1
    return 1 if top < 5 else need + -(-need // 4) + 1


def signatures(features: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
    """The signatures of a set of distinct 64-bit hashes. ``common``: sorted features that the first cut leaves out."""
    size = len(features)
    if size == 0:
        return np.zeros(0, np.uint64)
    tops = band_tops()
    own = int(np.searchsorted(tops, size))
    bands = [own] + ([own + 1] if size * 5 // 4 > tops[own] else [])
    out = []
    for cut in range(SCHEMES):
        if cut == 0:
            keys = features if common is None else features[~held(features, common)]
        else:
            keys = mix(features + np.uint64(cut))
        keys = np.sort(keys)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys ^ np.uint64(0x5851F42D4C957F2D)))])
        short = [b for b in bands if not _sign(keys, sums, size, int(tops[b]), b, cut, out)]
        bands = short
        if not bands:
            break
    return np.concatenate(out)


def held(features: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Which features are in a sorted list."""
    if len(common) == 0:
        return np.zeros(len(features), bool)
    return common[np.minimum(np.searchsorted(common, features), len(common) - 1)] == features


def _sign(keys: np.ndarray, sums: np.ndarray, size: int, top: int, band: int, cut: int, out: list) -> bool:
    """Append the signatures of one band and cut; whether the counts exceed what partners may differ in."""
    groups = group_count(top)
    parts = groups * SECOND
    edge = np.searchsorted(keys, _edges(parts))
    edge[-1] = len(keys)
    filled = np.diff(edge).reshape(groups, SECOND)
    content = np.diff(sums[edge]).reshape(groups, SECOND)
    counts = np.minimum((filled > 0).sum(axis=1), 2)
    before = np.cumsum(counts) - counts
    enough = int(counts.sum()) > most_different(size, top)
    signed = np.flatnonzero((before <= most_different(size, top)) & (counts > 0))
    if not enough and cut == SCHEMES - 1:
        signed = np.arange(groups)
    salt = np.uint64((band * SCHEMES + cut) * 64)
    for number, subset in enumerate(combinations(range(SECOND), SECOND - 1)):
        value = np.zeros(len(signed), np.uint64)
        some = np.zeros(len(signed), np.int64)
        for part in subset:
            value += mix(content[signed, part] + np.uint64(part + 1))
            some += filled[signed, part]
        made = mix(value ^ mix(signed.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt + np.uint64(number)))
        out.append(made if not enough and cut == SCHEMES - 1 else made[some > 0])
    return enough


@lru_cache(maxsize=256)
def _edges(parts: int) -> np.ndarray:
    """Bounds of equal ranges of the 64-bit numbers, with the ends."""
    step = (1 << 64) // parts
    inner = np.array([i * step for i in range(1, parts)], np.uint64)
    return np.concatenate([np.zeros(1, np.uint64), inner, np.full(1, (1 << 64) - 1, np.uint64)])
