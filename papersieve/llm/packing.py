"""Packing documents into sequences of a fixed length: dominance reduction, then best fit.

Documents become token ids with an end id; only those longer than a sequence are cut, so that every
piece but the first is full. How many pieces have which length is all that the plan needs: a
histogram with at most ``capacity`` entries, whatever the number of documents.

1. Dominance (Martello and Toth): for the longest remaining length, look at the sets that could
   share a sequence with it. Where one set of at most two pieces dominates all others (nothing else fits;
   a partner fills the rest exactly; no three pieces fit; or the largest partner is at least as
   long as any two that fit), that set is in some best packing and is fixed, as often as there are pieces.
2. Best fit: what is left goes, longest first, into the open sequences with the least room that holds it.
   Sequences with the same content are planned as one group with a count.

Pieces then get their places: a piece's rank among those of its length (counted per length and hash
bucket, so that a frequent length is spread over many tasks) selects the slot.

Defined cases: a null or empty text is the end id alone; repeated rows are packed one by one;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import slices, tidy
from .encoding import encoder, forgetting

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- the plan ------------------------------------------------------------------------------------


@dataclass
class Group:
    """``count`` sequences that all hold ``items``: (length, how many) in order."""

    count: int
    items: tuple[tuple[int, int], ...]


def _best_pair_sum(sizes: list[int], counts: dict[int, int], room: int) -> int:
    """The largest sum of two remaining pieces that is at most ``room`` (0: none)."""
    best, low, high = 0, 0, len(sizes) - 1
    while low <= high:
        if low == high and counts[sizes[low]] < 2:
            break
        total = sizes[low] + sizes[high]
        if total <= room:
            best, low = max(best, total), low + 1
        else:
            high -= 1
    return best


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> list[Group]:
    """Fix the sets that dominate all alternatives; takes them out of ``counts``."""
    fixed: list[Group] = []
    size = capacity
    while size > 0:
        while counts.get(size, 0) > 0:
            if not (found := _dominating_partner(counts, size, capacity)):
                break
            partner = found[0]
            if partner == 0:
                fixed.append(Group(counts.pop(size), ((size, 1),)))
                continue
            times = counts[size] // 2 if partner == size else min(counts[size], counts[partner])
            fixed.append(Group(times, ((size, 2),) if partner == size else ((size, 1), (partner, 1))))
            for taken in (size, partner):
                counts[taken] -= times
            for taken in {size, partner}:
                if counts[taken] == 0:
                    del counts[taken]
        size -= 1
    return fixed


def _dominating_partner(counts: dict[int, int], size: int, capacity: int) -> tuple[int] | None:
    """The partner (0: none) whose set with ``size`` dominates all sets that hold ``size``."""
    counts = dict(counts)
    counts[size] -= 1
    room = capacity - size
    sizes = sorted(s for s, n in counts.items() if n > 0 and s <= room)
    if not sizes:
        return (0,)
    smallest: list[int] = []
    for s in sizes:
        smallest += [s] * min(counts[s], 3)
        if len(smallest) >= 3:
            break
    largest, pair, triple = sizes[-1], smallest[:2], smallest[:3]
    if largest == room or len(pair) < 2 or sum(pair) > room:
        return (largest,)
    if (len(triple) < 3 or sum(triple) > room) and largest >= _best_pair_sum(sizes, counts, room):
        return (largest,)
    return None


def best_fit(counts: dict[int, int], capacity: int) -> list[Group]:
    """Longest first, each piece into the open sequence with the least room that holds it."""
    open_by_room: dict[int, list[Group]] = {}
    done: list[Group] = []

    def put(group: Group, room: int) -> None:
        if room:
            open_by_room.setdefault(room, []).append(group)
        else:
            done.append(group)

    def fill(group: Group, room: int, size: int, left: int) -> int:
        """Fill sequences of a group with as many as fit; returns what is left over."""
        each = room // size
        full = min(group.count, left // each)
        if full:
            put(Group(full, (*group.items, (size, each))), room - each * size)
            left -= full * each
        rest = group.count - full
        if rest and left:
            put(Group(1, (*group.items, (size, left))), room - left * size)
            rest, left = rest - 1, 0
        if rest:
            put(Group(rest, group.items), room)
        return left

    for size in sorted(counts, reverse=True):
        left = counts[size]
        for room in sorted(r for r in open_by_room if r >= size):
            groups = open_by_room.pop(room)
            for number, group in enumerate(groups):
                if not left:
                    open_by_room.setdefault(room, []).extend(groups[number:])
                    break
                left = fill(group, room, size, left)
            if not left:
                break
        if left:
            fill(Group(-(-left // (capacity // size)), ()), capacity, size, left)
    return done + [g for groups in open_by_room.values() for g in groups]


@dataclass
class Slots:
    """Places by length: of the pieces of a length, those ranked from ``rank`` on go to sequence
    ``first`` onwards, one each, at ``offset``. ``key`` is length * 2**40 + rank, ascending."""

    key: np.ndarray
    first: np.ndarray
    offset: np.ndarray
    sequences: int = field(default=0)


def plan(counts: dict[int, int], capacity: int) -> Slots:
    counts = dict(counts)
    groups = reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)
    used: dict[int, int] = {}
    rows, first = [], 0
    for group in groups:
        offset = 0
        for size, times in group.items:
            for _ in range(times):
                rank = used.get(size, 0)
                rows.append((size << 40 | rank, first, offset))
                used[size] = rank + group.count
                offset += size
        first += group.count
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return Slots(table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy(), first)


# --- the data ------------------------------------------------------------------------------------


def cut_pieces(ids: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids; only the first piece may be shorter."""
    n = len(ids) // 4
    first = n if n <= capacity else n % capacity or capacity
    start, piece = 0, 0
    while start < n:
        length = first if piece == 0 else capacity
        yield piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])
        start, piece = start + length, piece + 1


def tokenised_pieces(documents: DataFrame, tokenizer_path: str, capacity: int, end_id: int, release: bool = False) -> DataFrame:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = encoder(tokenizer_path), int(end_id).to_bytes(4, "little")
        for batch in slices(batches, "text"):
            rows = [
                (doc, *part)
                for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist())
                for part in cut_pieces(own.encode(text) + end, capacity)
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    run = tidy(forgetting(tokenizer_path, run) if release else run)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)


def ranked(pieces: DataFrame) -> DataFrame:
    """Number the pieces of each length from 0, without bringing a length into one task."""
    spark = pieces.sparkSession
    buckets = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)))
    sizes = dealt.groupBy("length", "bucket").count()
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = dealt.withColumn("own", F.row_number().over(own) - 1)
    return numbered.join(starts, ["length", "bucket"]).withColumn("rank", F.col("before") + F.col("own")).drop(
        "bucket", "before", "own"
    )


def pack(documents: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, release: bool = False) -> DataFrame:
    """Pieces of all documents with their sequence and offset.

    The histogram on the driver has at most ``capacity`` entries; the slots that tasks get are the
    planned groups, of which each length opens or splits at most four. ``release``: tasks forget the runs they have encoded when they
    end, which costs time and spares memory where other steps follow in the same workers.
    """
    pieces = cut_lineage(tokenised_pieces(documents, tokenizer_path, capacity, end_id, release))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = plan(histogram, capacity)
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
            ("ids_crc32", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
        ]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch["length"].to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch["rank"].to_numpy(zero_copy_only=False).astype(np.int64)
            key = (length << 40) | rank
            at = np.searchsorted(slots.key, key, "right") - 1
            sequence = slots.first[at] + (key - slots.key[at])
            kept = [batch[n] for n in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(slots.offset[at])], schema=schema)

    return ranked(pieces).mapInArrow(place, f"{PIECES}, sequence_id long, offset long")
