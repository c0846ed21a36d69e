"""N-gram Jaccard join of documents by PartEnum signatures, and the components of its links.

1. Profile each document: the size of its shingle set and a sketch of it. Count which shingles very many documents
   hold (a bounded list, see ``common_features``).
2. Sign every document's shingle set (``partenum``): linked documents share a signature. Of equal sets that a task meets only
   the first signs in full, the others only as a whole set.
3. Bring equal signatures together, sorted, and stream through them: the first document of a signature is its pivot. Nothing is
   gathered, however many documents share one.
4. Verify each (pivot, document) pair once. Linked sets differ in at most (a + b) / 9 features, so their sizes and
   sketches must be that near; pairs whose are get their texts and an exact intersection. Frequent pivots are salted over several tasks.
5. Components of the links. Where the documents of a signature, its pivot aside, still belong to more than one
   component, pairs among them are open. They are settled by a prefix join: shingles in one order, common ones last, the
   first fifth of each document as join keys, with the length and positional bounds and the parities (``parities``) in the join condition, for pairs in different components only; the pairs found are verified as in 4. No link is lost: a linked pair shares a signature, so it is verified
   with the pivot, is already in one component, or is open.

Texts are joined to the pairs by doc_id: the pairs are sent to the texts where they take at most ``BROADCAST_BYTES``, by their count, and
both sides are shuffled otherwise.

Defined cases: null, empty and blank texts have an empty set, link with nothing and are their own component; a text with fewer words than a
shingle is one shingle; rows with equal doc_id are one node (each row keeps its own count); a row without doc_id
links with nothing and has no component; equal sets link; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import slices, text_buffers, tidy, without
from .components import components
from .hashing import LOWER, gram_hashes, mix, word_hashes, words
from .partenum import held, signatures

WORDS = 5
BROADCAST_BYTES = 16 << 20
# Documents that one task verifies against one pivot.
PER_SALT = 120
# A shingle is common if one in so many documents, or more, holds it.
COMMON_SHARE = 4000
# Shingles that a task counts before it passes on the frequent ones.
COUNTED = 4_000_000
# Counters of a sketch.
BINS = 256
# Parity bits of sets of up to so many features, as (features, bits); larger sets have the last number of bits.
PARITY_BITS = ((600, 512), (1 << 62, 2048))
# Whole-set signatures that a task remembers.
SEEN_SETS = 200_000


def shingle_sets(texts: pa.Array, n: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, at = text_buffers(texts)
    data = LOWER[data]
    starts, ends, first = words(data, at)
    hashes = word_hashes(data, starts, ends)
    grams = gram_hashes(hashes, n)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            yield np.unique(grams[a : b - n + 1])
        elif b > a:
            yield gram_hashes(hashes[a:b], b - a)
        else:
            yield np.zeros(0, np.uint64)


def parities(features: np.ndarray) -> np.ndarray:
    """Bits that tell whether the features with each remainder are an odd number, as 64-bit numbers.

    Two sets differ in at least as many features as their parities in bits.
    """
    bits = next(bits for most, bits in PARITY_BITS if len(features) <= most)
    counts = np.bincount((features & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts.astype(np.uint8) & 1).view(np.int64)


def folded(parity: np.ndarray) -> np.ndarray:
    """The parities for a quarter of the remainders."""
    return np.bitwise_xor.reduce(parity.reshape(4, -1), axis=0)


def linked(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both > 0 and 100 * both >= 80 * (len(x) + len(y) - both)


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc"), F.col("text").cast("string").alias("text"))


def common_features(documents: DataFrame) -> np.ndarray:
    """Shingles that at least one in ``COMMON_SHARE`` documents holds, sorted.

    Each task counts the shingles of some thousand documents at a time and passes on those that half that share of them
    hold; the counts are added up. The list holds at most ``COMMON_SHARE`` times the mean number of shingles, whatever the
    number of documents. It only steers signatures: results do not depend on it.
    """

    def counted(held: list[np.ndarray], n: int) -> pa.RecordBatch:
        features, counts = np.unique(np.concatenate([np.zeros(0, np.uint64), *held]), return_counts=True)
        kept = counts >= max(2, n // (2 * COMMON_SHARE))
        return pa.RecordBatch.from_arrays([pa.array(features[kept].view(np.int64)), pa.array(counts[kept])], ["feature", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, n = [], 0, 0
        for batch in slices(batches, "text"):
            for features in shingle_sets(batch["text"]):
                held.append(features)
                size += len(features)
            n += batch.num_rows
            if size >= COUNTED:
                yield counted(held, n)
                held, size, n = [], 0, 0
        yield counted(held, n)

    rows = _texts(documents)
    total = rows.count()
    added = rows.select("text").mapInArrow(tidy(run), "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    common = added.filter(F.col("n") >= max(8, total // COMMON_SHARE)).select("feature").toPandas()["feature"]
    return np.sort(common.to_numpy(np.int64).view(np.uint64))


def signed(documents: DataFrame, common: np.ndarray) -> DataFrame:
    """(sig, doc)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches, "text"):
            sigs, docs = [], []
            for doc, features in zip(batch["doc"].to_pylist(), shingle_sets(batch["text"])):
                if len(features) == 0:
                    continue
                whole = mix(np.array([np.add.reduce(mix(features)) + np.uint64(len(features))]))
                own = whole
                if int(whole[0]) not in seen:
                    own = np.concatenate([whole, signatures(features, common)])
                    if len(seen) < SEEN_SETS:
                        seen.add(int(whole[0]))
                sigs.append(own)
                docs.append(np.full(len(own), doc, np.int64))
            if sigs:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(docs))], ["sig", "doc"])

    return _texts(documents).filter("doc is not null").mapInArrow(tidy(run), "sig long, doc long")


def buckets(sigs: DataFrame) -> DataFrame:
    """(sig, doc, pivot, many) of signatures that at least two rows share; many: not just two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: tuple[int, int, bool] | None = None  # signature, pivot, whether the pivot's row is out
        for batch in batches:
            sig, doc = (batch[c].to_numpy(zero_copy_only=False) for c in ("sig", "doc"))
            if len(sig) == 0:
                continue
            if carried:
                sig, doc = np.append(carried[0], sig), np.append(carried[1], doc)
            start = np.flatnonzero(np.append(True, sig[1:] != sig[:-1]))
            count = np.diff(np.append(start, len(sig)))
            pivot, size = np.repeat(doc[start], count), np.repeat(count, count)
            many = size > 2
            many[start[-1] :] = True  # may go on in the next batch
            out = size > 1
            old = bool(carried and carried[2])
            if old:
                out[0] = False
                many[: count[0]] = True
                out[1 : count[0]] = True
            carried = (int(sig[start[-1]]), int(doc[start[-1]]), bool(count[-1] > 1 or (old and len(start) == 1)))
            if out.any():
                yield pa.RecordBatch.from_arrays([pa.array(a[out]) for a in (sig, doc, pivot, many)], ["sig", "doc", "pivot", "many"])

    ordered = sigs.repartition("sig").sortWithinPartitions("sig", "doc")
    return ordered.mapInArrow(tidy(run), "sig long, doc long, pivot long, many boolean")


def profiles(documents: DataFrame) -> DataFrame:
    """(doc, size, sketch) of every row. A sketch counts the features in ``BINS`` equal ranges of the hash, up to 255."""
    edges = np.arange(1, BINS, dtype=np.uint64) << np.uint64(64 - BINS.bit_length() + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, sketches = [], []
            for features in shingle_sets(batch["text"]):
                places = np.concatenate([[0], np.searchsorted(features, edges), [len(features)]])
                sizes.append(len(features))
                sketches.append(np.minimum(np.diff(places), 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays([batch["doc"], pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary())], ["doc", "size", "sketch"])

    return _texts(documents).mapInArrow(tidy(run), "doc long, size long, sketch binary")


def plausible(pairs: DataFrame, profile: DataFrame) -> DataFrame:
    """The pairs (pivot, doc) whose sizes and sketches do not rule a link out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketch = lambda c: np.frombuffer(b"".join(batch[c].to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)  # noqa: B023, E731
            most = (batch["x_size"].to_numpy() + batch["y_size"].to_numpy()) // 9
            near = np.abs(sketch("x_sketch") - sketch("y_sketch")).sum(axis=1) <= most
            yield pa.RecordBatch.from_arrays([batch["pivot"], batch["doc"]], ["pivot", "doc"]).filter(pa.array(near))

    x = profile.select(F.col("doc").alias("pivot"), F.col("size").alias("x_size"), F.col("sketch").alias("x_sketch"))
    y = profile.select("doc", F.col("size").alias("y_size"), F.col("sketch").alias("y_sketch"))
    sized = pairs.join(x.drop("x_sketch"), "pivot").join(y.drop("y_sketch"), "doc")
    sized = sized.filter(5 * F.least("x_size", "y_size") >= 4 * F.greatest("x_size", "y_size")).select("pivot", "doc")
    rows = sized.distinct().join(x, "pivot").join(y, "doc")
    return rows.mapInArrow(tidy(run), "pivot long, doc long").distinct()


def _with_texts(documents: DataFrame, need: DataFrame, row_bytes: int) -> DataFrame:
    need = cut_lineage(need)
    small = need.count() * row_bytes <= BROADCAST_BYTES
    return _texts(documents).join(F.broadcast(need) if small else need, "doc")


def verify(documents: DataFrame, pairs: DataFrame) -> DataFrame:
    """The links (a, b) among distinct pairs (pivot, doc)."""
    counts = pairs.groupBy("pivot").agg(F.count("*").alias("n"))
    dealt = counts.select("pivot", F.ceil(F.col("n") / PER_SALT).cast("int").alias("salts"))
    members = pairs.join(dealt, "pivot").select(
        "doc", "pivot", F.pmod(F.xxhash64("doc"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role")
    )
    pivots = dealt.select(
        F.col("pivot").alias("doc"), "pivot", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in slices(batches, "text"):
            found = []
            keys = zip(*(batch[c].to_pylist() for c in ("pivot", "salt", "role", "doc")))
            for (pivot, salt, role, doc), features in zip(keys, shingle_sets(batch["text"])):
                if (pivot, salt) != at:
                    at, own = (pivot, salt), []
                if role == 0:
                    if not any(np.array_equal(features, o) for o in own):
                        own.append(features)
                elif any(linked(features, o) for o in own):
                    found.append((pivot, doc))
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    rows = _with_texts(documents, members.union(pivots), 64)
    ordered = rows.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "role")
    return ordered.mapInArrow(tidy(run), "a long, b long")


def open_rows(shared: DataFrame, found: DataFrame) -> DataFrame:
    """(doc, comp) of the documents among which pairs are open."""
    rows = shared.filter("many and doc <> pivot").select("sig", "doc")
    rows = rows.join(found.select(F.col("node").alias("doc"), F.col("component").alias("comp")), "doc", "left")
    rows = rows.select("sig", "doc", F.coalesce("comp", "doc").alias("comp"))
    split = rows.groupBy("sig").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low <> high")
    return rows.join(split.select("sig"), "sig", "left_semi").select("doc", "comp").distinct()


def prefix_pairs(documents: DataFrame, rows: DataFrame, common: np.ndarray) -> DataFrame:
    """Distinct pairs (pivot, doc) of rows (doc, comp) in different components that may be linked.

    Any order of the shingles that all documents share will do; common ones come last, so that documents which
    have little but a frequent passage in common seldom meet. Linked sets differ in at most (a + b) / 9 features, and so in no more
    parities; unlike sets differ in more, and leave no row although they share a prefix. Sizes of linked sets are within a quarter of each other,
    so their numbers of bits are equal or a step apart, for which the longer one is folded.
    """

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            keys, counts, sizes, rest, odd = [], [], [], [], []
            for features in shingle_sets(batch["text"]):
                size = len(features)
                frequent = held(features, common)
                first = size - (4 * size + 4) // 5 + 1 if size else 0
                keys.append(np.concatenate([features[~frequent], features[frequent]])[:first])
                counts.append(first)
                sizes.append(size)
                rest.append(size - np.arange(first))
                odd.append(parities(features))
            own = np.repeat(np.arange(len(sizes)), counts)
            docs, comps = (batch[c].to_numpy(zero_copy_only=False) for c in ("doc", "comp"))
            columns = [docs[own], comps[own], np.array(sizes)[own], np.concatenate(keys).view(np.int64), np.concatenate(rest)]
            columns = [pa.array(c, pa.int64()) for c in columns]
            columns += [pa.array(bits, pa.list_(pa.int64())).take(pa.array(own)) for bits in (odd, [folded(o) for o in odd])]
            yield pa.RecordBatch.from_arrays(columns, ["doc", "comp", "size", "feature", "rest", "odd", "folded"])

    schema = "doc long, comp long, size long, feature long, rest long, odd array<long>, folded array<long>"
    keys = cut_lineage(_with_texts(documents, rows, 48).mapInArrow(tidy(prefixes), schema))
    x, y = keys.alias("x"), keys.alias("y")
    both = F.col("x.size") + F.col("y.size")

    def different(a: str, b: str) -> Column:
        bits = F.zip_with(a, b, lambda v, w: F.bit_count(v.bitwiseXOR(w)))
        return F.aggregate(bits, F.lit(0), lambda total, n: total + n)

    larger = F.size("x.odd") - F.size("y.odd")
    least = F.when(larger > 0, different("x.folded", "y.odd")).when(larger < 0, different("x.odd", "y.folded"))
    close = (
        (F.col("x.feature") == F.col("y.feature"))
        & (F.col("x.doc") < F.col("y.doc"))
        & (F.col("x.comp") != F.col("y.comp"))
        & (5 * F.least("x.size", "y.size") >= 4 * F.greatest("x.size", "y.size"))
        & (9 * F.least("x.rest", "y.rest") >= 4 * both)
        & (9 * least.otherwise(different("x.odd", "y.odd")) <= both)
    )
    return x.join(y, close).select(F.col("x.doc").alias("pivot"), F.col("y.doc").alias("doc")).distinct()


def link_components(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The profiles of all rows, and (node, component) of linked documents."""
    profile = cut_lineage(profiles(documents))
    common = common_features(documents)
    shared = cut_lineage(buckets(signed(documents, common)))
    pairs = cut_lineage(shared.filter("doc <> pivot").select("pivot", "doc").distinct())
    links = cut_lineage(verify(documents, cut_lineage(plausible(pairs, profile))))
    found = components(links)
    opened = prefix_pairs(documents, open_rows(shared, found), common).join(pairs, ["pivot", "doc"], "left_anti")
    more = cut_lineage(plausible(cut_lineage(opened), profile))
    return profile, components(links.union(verify(documents, more)))


def join(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of documents."""
    profile, found = link_components(documents)
    rows = profile.select("doc", F.col("size").alias("n_shingles"))
    joined = rows.join(found, rows["doc"] == found["node"], "left")
    return joined.select(F.col("doc").alias("doc_id"), "n_shingles", F.coalesce("component", "doc").alias("component_id"))


def keep_one(documents: DataFrame) -> DataFrame:
    """The rows, with all columns, of the smallest doc_id of each component. Rows of one doc_id are one document."""
    _, found = link_components(documents)
    return without(documents, found.filter("node <> component").select(F.col("node").alias("doc_id")), "doc_id")
