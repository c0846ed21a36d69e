"""Token-id files of patched frame-of-reference blocks.

A shard file holds the ids of consecutive documents in ascending doc_id order:

    header   8 bytes magic, then four unsigned 64-bit numbers: documents, ids, blocks, payload bytes
    docs     doc_id (signed 64-bit) and number of ids (unsigned 64-bit) of each document
    index    byte at which each block starts in the payload (unsigned 64-bit)
    payload  the blocks

A block has 128 ids (the last of a file is padded with its minimum):

    minimum (unsigned 32-bit), width in bits, number of exceptions (a byte each), 2 bytes unused,
    128 packed differences to the minimum, width bits each, value i from bit i * width of the 32-bit words on,
    the exceptions' places (a byte each, padded to 4) and their whole differences (unsigned 32-bit each)

The width is the smallest that holds nine tenths of a block's differences; what needs more is an
exception, whose packed low bits are replaced on reading. All numbers are little-endian.

``write`` range-partitions documents by doc_id and lets each task write its shards below the given
folder under names that depend on the task's partition, through a temporary name and a rename, so
a task that runs again replaces its own files. ``read`` decodes the files, one document a row.

Defined cases: null or empty text: the end id alone; rows with equal doc_id are kept, in any order
between them; a null doc_id comes first (written as the smallest 64-bit number and read back as null);
an empty table writes no file; a text of any length is one document in one shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import slices, tidy
from .encoding import encoder

MAGIC = b"PFORIDS1"
BLOCK = 128
# Ids after which a shard is closed; a shard of this size takes at most some 16 MB.
SHARD_IDS = 1 << 22
PERCENTILE = 0.9
_NO_ID = -(1 << 63)


def _widths(largest: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    return np.ceil(np.log2(largest.astype(np.float64) + 1)).astype(np.int64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, 128) differences as (blocks, 4 * width) 32-bit words."""
    columns = np.ascontiguousarray((values & np.uint64((1 << width) - 1)).T)
    words = np.zeros((4 * width + 1, len(values)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 32)
        moved = columns[i] << np.uint64(shift)
        words[word] |= moved & np.uint64(0xFFFFFFFF)
        if shift + width > 32:
            words[word + 1] |= moved >> np.uint64(32)
    return np.ascontiguousarray(words[: 4 * width].T).astype("<u4")


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    columns = np.ascontiguousarray(words.T).astype(np.uint64)
    out = np.zeros((BLOCK, len(words)), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 32)
        value = columns[word] >> np.uint64(shift) if width else 0
        if shift + width > 32:
            value = value | columns[word + 1] << np.uint64(32 - shift)
        out[i] = value & np.uint64((1 << width) - 1) if width else 0
    return np.ascontiguousarray(out.T)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """The index and the payload of unsigned 32-bit ids."""
    if len(ids) == 0:
        return np.zeros(0, "<u8"), b""
    n = -(-len(ids) // BLOCK)
    rows = np.full(n * BLOCK, 0, np.uint64)
    rows[: len(ids)] = ids
    rows[len(ids) :] = ids[(n - 1) * BLOCK :].min()
    rows = rows.reshape(n, BLOCK)
    least = rows.min(axis=1)
    rows = rows - least[:, None]
    width = _widths(np.sort(rows, axis=1)[:, int(np.ceil(PERCENTILE * BLOCK)) - 1])
    odd = rows >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    n_odd = odd.sum(axis=1)
    places_size = -(-n_odd // 4) * 4
    size = 8 + 16 * width + places_size + 4 * n_odd
    index = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)

    def put(at: np.ndarray, raw: np.ndarray) -> None:
        out[at[:, None] + np.arange(raw.shape[1])] = raw

    put(index, np.ascontiguousarray(least.astype("<u4")).view(np.uint8).reshape(n, 4))
    out[index + 4], out[index + 5] = width, n_odd
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            put(index[own] + 8, _pack(rows[own], int(w)).view(np.uint8).reshape(len(own), -1))
    block, place = np.nonzero(odd)
    if len(block):
        rank = np.arange(len(block)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        base = index[block] + 8 + 16 * width[block]
        out[base + rank] = place
        put(base + places_size[block] + 4 * rank, rows[block, place].astype("<u4").view(np.uint8).reshape(-1, 4))
    return index.astype("<u8"), out.tobytes()


def decode_blocks(index: np.ndarray, payload: np.ndarray, count: int) -> np.ndarray:
    n = len(index)
    if n == 0:
        return np.zeros(0, np.uint32)
    index = index.astype(np.int64)
    get = lambda at, size: payload[at[:, None] + np.arange(size)]
    least = np.ascontiguousarray(get(index, 4)).view("<u4").reshape(n).astype(np.uint64)
    width, n_odd = payload[index + 4].astype(np.int64), payload[index + 5].astype(np.int64)
    rows = np.zeros((n, BLOCK), np.uint64)
    for w in np.unique(width):
        if w:
            own = np.flatnonzero(width == w)
            rows[own] = _unpack(np.ascontiguousarray(get(index[own] + 8, 16 * int(w))).view("<u4"), int(w))
    if n_odd.any():
        block = np.repeat(np.arange(n), n_odd)
        rank = np.arange(len(block)) - np.repeat(np.cumsum(n_odd) - n_odd, n_odd)
        base = index[block] + 8 + 16 * width[block]
        values = get(base + -(-n_odd[block] // 4) * 4 + 4 * rank, 4)
        rows[block, payload[base + rank]] = np.ascontiguousarray(values).view("<u4").reshape(-1)
    return (rows + least[:, None]).reshape(-1)[:count].astype(np.uint32)


def to_file(doc_ids: list[int], sizes: list[int], ids: np.ndarray) -> bytes:
    index, payload = encode_blocks(ids)
    head = np.array([len(doc_ids), len(ids), len(index), len(payload)], "<u8").tobytes()
    docs = np.array(doc_ids, "<i8").tobytes() + np.array(sizes, "<u8").tobytes()
    return MAGIC + head + docs + index.tobytes() + payload


def from_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, ids of each document, all ids."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token-id file")
    n_docs, n_ids, n_blocks, n_bytes = (int(x) for x in np.frombuffer(raw, "<u8", 4, 8))
    at = 40
    doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
    sizes = np.frombuffer(raw, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
    at += 16 * n_docs
    index = np.frombuffer(raw, "<u8", n_blocks, at)
    payload = np.frombuffer(raw, np.uint8, n_bytes, at + 8 * n_blocks)
    return doc_ids, sizes, decode_blocks(index, payload, n_ids)


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write(documents: DataFrame, folder: str, tokenizer_path: str, end_id: int = 1) -> DataFrame:
    """Write all documents; returns a row per file: shard, docs, ids, path (runs when it is read)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, root = _store(folder)
        own, end = encoder(tokenizer_path), int(end_id).to_bytes(4, "little")
        doc_ids, parts, held, number = [], [], 0, 0

        def close():
            nonlocal doc_ids, parts, held, number
            name = f"{part:06d}-{number:05d}.ids"
            ids = np.frombuffer(b"".join(parts), "<u4")
            store.create_dir(root)
            with store.open_output_stream(f"{root}/.{name}.{attempt}") as out:
                out.write(to_file(doc_ids, [len(p) // 4 for p in parts], ids))
            store.move(f"{root}/.{name}.{attempt}", f"{root}/{name}")
            row = [[name], [len(doc_ids)], [len(ids)], [f"{folder}/{name}"]]
            doc_ids, parts, held, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array(c) for c in row], ["shard", "docs", "ids", "path"])

        for batch in slices(batches, "text"):
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                doc_ids.append(_NO_ID if doc is None else doc)
                parts.append(own.encode(text) + end)
                held += len(parts[-1]) // 4
                if held >= SHARD_IDS:
                    yield close()
        if doc_ids:
            yield close()

    spark = documents.sparkSession
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = rows.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "doc_id").sortWithinPartitions("doc_id")
    return ordered.mapInArrow(tidy(run), "shard string, docs long, ids long, path string")


def read(spark: SparkSession, shards: DataFrame) -> DataFrame:
    """(shard, doc_id, start in the shard, n_tokens, token_ids as bytes) from the files of ``shards``."""
    schema = T.StructType().add("shard", "string").add("doc_id", "long").add("start_in_shard", "long")
    schema = schema.add("n_tokens", "long").add("token_ids", "binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, path in zip(batch["shard"].to_pylist(), batch["path"].to_pylist()):
                store, name = _store(path)
                with store.open_input_stream(name) as source:
                    doc_ids, sizes, ids = from_file(source.read())
                ends = np.cumsum(sizes)
                for a in range(0, len(doc_ids), 512):
                    b = min(a + 512, len(doc_ids))
                    raw = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends[a:b], sizes[a:b])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([shard] * (b - a)),
                            pa.array(doc_ids[a:b], mask=doc_ids[a:b] == _NO_ID),
                            pa.array(ends[a:b] - sizes[a:b]),
                            pa.array(sizes[a:b]),
                            pa.array(raw, pa.binary()),
                        ],
                        ["shard", "doc_id", "start_in_shard", "n_tokens", "token_ids"],
                    )

    files = max(1, shards.count())
    return shards.select("shard", "path").repartition(min(files, 100_000), "shard").mapInArrow(tidy(run), schema)


def starts(shards: DataFrame) -> DataFrame:
    """(shard, first): ids in all shards before each. One row for each file, a few bytes."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return shards.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("first"))


def digest(tokens: DataFrame, first: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of documents read back."""
    crc = F.crc32("token_ids")
    rows = tokens.select("shard", "doc_id", "start_in_shard", "n_tokens", crc.alias("ids_crc32"))
    # One row for each file goes to the rows, never the rows to the files' table.
    return rows.join(F.broadcast(first), "shard").select(
        "doc_id", (F.col("first") + F.col("start_in_shard")).alias("start"), "n_tokens", "ids_crc32"
    )

