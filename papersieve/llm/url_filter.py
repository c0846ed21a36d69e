"""URL rules judged through Bloom filter cascades.

A cascade answers "is this key listed?" exactly for every key of a known universe:
level 1 holds the listed keys, level 2 the unlisted keys of the universe that level 1 lets
through, level 3 the listed keys that level 2 lets through, and so on until nothing wrong
is left. Judging a URL is then a few bit tests per key, with no join.

The universe is the corpus's own keys: of each URL, the last labels of its host with the
first characters of its path, in the shapes (labels, characters) that the rules have. Level 1
lets about as many unlisted keys through as there are listed ones, so a cascade has about
1.5 * log2(universe / listed) + 4 bits for each *rule*; it grows with the rule list and only by
the logarithm of the corpus. ``MOST_BITS`` bounds what is sent to the executors.

Defined cases: a null URL or one without ``://`` has an empty host and path and no rule; without a
rule the verdict is ``allow``; a key listed under both actions is blocked; repeated rows
are judged one by one; an empty rule list or table gives verdicts or rows all the same;
other columns of the input are not read.
"""

from __future__ import annotations

import math
import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

MOST_BITS = 1 << 27
# A byte of a level holds so many bits: it is one ASCII character, which built-in functions turn into a number.
_BYTE = 7
# Bits that one row of the table from which a level is filled holds.
_WORD = 8 * _BYTE


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


@dataclass(frozen=True)
class Level:
    """One Bloom filter. Its bits are a single binary literal, shared by all tests of the level."""

    data: bytearray
    bits: int
    hashes: int
    seed: int

    def places(self, key: Column) -> list[Column]:
        a = F.pmod(F.xxhash64(key, F.lit(2 * self.seed)), F.lit(self.bits))
        b = F.pmod(F.xxhash64(key, F.lit(2 * self.seed + 1)), F.lit(self.bits))
        return [F.pmod(a + b * i, F.lit(self.bits)) for i in range(self.hashes)]

    def passes(self, key: Column) -> Column:
        data, out = F.lit(self.data), F.lit(True)
        for place in self.places(key):
            byte = F.substring(data, F.floor(place / _BYTE).cast("int") + 1, F.lit(1))
            out = out & (F.getbit(F.ascii(byte.cast("string")), (place % _BYTE).cast("int")) == 1)
        return out


def fill_level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """Encode the distinct ``key`` column; ``rate`` of other keys may pass."""
    hashes = max(1, round(-math.log2(rate)))
    bits = -(-max(4 * _WORD, math.ceil(1.45 * count * hashes)) // _WORD) * _WORD
    if bits > MOST_BITS:
        raise ValueError(f"{count} listed keys need {bits} bits; at most {MOST_BITS} are sent out")
    level = Level(bytearray(), bits, hashes, seed)
    place = keys.select(F.explode(F.array(*level.places(F.col("key")))).alias("at"))
    bit = F.expr(f"shiftleft(1L, cast(at % {_WORD} as int))")
    filled = place.groupBy(F.floor(F.col("at") / _WORD).alias("word")).agg(F.bit_or(bit).alias("value"))
    data = bytearray(bits // _BYTE)
    for row in filled.toLocalIterator():
        for i in range(8):
            data[8 * row["word"] + i] = row["value"] >> _BYTE * i & 127
    return Level(data, bits, hashes, seed)


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        out = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            out = F.when(self.levels[number - 1].passes(key), out).otherwise(F.lit(number % 2 == 0))
        return out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed`` and ``universe`` have a ``key`` column; the universe may repeat keys."""
    listed = cut_lineage(listed.select("key").filter("key is not null").distinct())
    n_listed = listed.count()
    if n_listed == 0:
        return Cascade(())
    marked = universe.select("key", F.lit(0).alias("is_listed")).union(listed.select("key", F.lit(1)))
    unlisted = marked.groupBy("key").agg(F.max("is_listed").alias("is_listed")).filter("is_listed = 0").select("key")
    n_unlisted = unlisted.count()
    levels, own, other, n_own = [], listed, unlisted, n_listed
    rate = min(0.5, n_listed / max(1, n_unlisted))
    while n_own:
        level = fill_level(own, n_own, rate, len(levels))
        levels.append(level)
        wrong = cut_lineage(other.filter(level.passes(F.col("key"))))
        own, other, n_own, rate = wrong, own, wrong.count(), 0.5
    return Cascade(tuple(levels))


def shapes_of(rules: DataFrame) -> list[tuple[int, int]]:
    """The (host labels, path characters) that rules have; bounded by label depth times path lengths."""
    labels = F.size(F.split("host", r"\.", -1))
    rows = rules.select(labels.alias("labels"), F.length("path").alias("chars")).distinct().collect()
    return sorted((r["labels"], r["chars"]) for r in rows)


def candidate_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a URL in the given shapes, as array<struct<size, labels, key>>."""
    have = F.size(F.split(host, r"\.", -1))
    keys = [
        F.when((have >= n) & (F.length(path) >= c), F.concat(F.substring_index(host, ".", -n), F.substring(path, 1, c)))
        for n, c in shapes
    ]
    made = [
        F.when(k.isNotNull(), F.struct(F.length(k).alias("size"), F.lit(n).alias("labels"), k.alias("key")))
        for k, (n, _) in zip(keys, shapes)
    ]
    return F.array_compact(F.array(*made)) if made else F.array().cast("array<struct<size:int,labels:int,key:string>>")


def _listed_in(cascade: Cascade) -> Column:
    return F.filter("keys", lambda c: cascade.holds(c["key"]))


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url") -> DataFrame:
    """Verdicts for URLs. ``rules`` has ``action`` (allow or block), ``host`` and ``path``.

    Returns ``key``, host, path, rule, verdict, one row per input row.
    """
    shapes = shapes_of(rules)
    parts = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    universe = parts.select(F.explode(candidate_keys(F.col("host"), F.col("path"), shapes)).alias("c")).select("c.key")
    listed = rules.select("action", F.concat("host", "path").alias("key"))
    cascades = {a: build_cascade(listed.filter(F.col("action") == a), universe) for a in ("block", "allow")}
    best = {a: F.array_max(_listed_in(cascade)) for a, cascade in cascades.items()}
    out = parts.withColumn("keys", candidate_keys(F.col("host"), F.col("path"), shapes))
    out = out.select(key, "host", "path", *[best[a].alias(f"_{a}") for a in best])
    block, allow = F.col("_block"), F.col("_allow")
    allowed = allow.isNotNull() & (block.isNull() | (block < allow))
    return out.select(
        key,
        "host",
        "path",
        F.when(allowed, F.col("_allow.key")).otherwise(F.col("_block.key")).alias("rule"),
        F.when(allowed | block.isNull(), "allow").otherwise("block").alias("verdict"),
    )
