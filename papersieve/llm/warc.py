"""WARC archives: writing, reading, and deduplication by revisit records.

``capture`` writes one response record per row. ``headers`` reads what archives hold, without passing payloads on. ``deduplicate``
resolves revisits: the headers alone are shuffled by payload digest and length, the response with the smallest key of each group is its
original, every other record of the group is joined to it, and the archives are written anew: originals with their payload,
the others as revisit records that refer to the original, all with fresh headers (new record ids, lengths, digests and references;
the date of capture stays). ``resolve`` joins the revisits of archives to their responses.

Each record is a gzip member of its own. A response's block is an HTTP head and the payload, a revisit's the HTTP head alone. The row's
key stands in the field ``X-Row-Key``. A new record id is made from the folder and the old id, so a task that writes a revisit knows
the id that another task gives to the original.

Tasks write files of about ``FILE_BYTES`` into a folder that all executors reach, under names with the attempt's number, and
return a row per file. These rows are stored, and only files named there count, so a task that runs again or is lost leaves
nothing that is read. Payloads are handled one at a time; no group of copies is ever gathered.

Defined cases: a null payload is empty; a null url is written as ``about:blank``; characters that a header cannot hold are
percent-encoded in urls; a null key is written without a key field, is read as null and comes after all others; of rows with equal key and payload the
first record in file order is the original; payloads below ``least`` bytes are never revisits; a revisit of the input whose group has no response stays
as it was; an empty table gives no file; other columns are not read.
"""

from __future__ import annotations

import hashlib
import string
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .base import slices, tidy

# Compressed bytes after which a file is closed.
FILE_BYTES = 32 << 20
LEAST_REVISIT = 100
# Fixed values of the format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"

_SAFE = "".join(c for c in string.printable if c.isprintable() and c not in ' <>"')
_READ_BYTES = 1 << 16
_HEADERS_PER_BATCH = 1000

FILES = "file string, records bigint, bytes bigint"
HEADERS = (
    T.StructType()
    .add("file", "string")
    .add("number", "long")
    .add("record_type", "string")
    .add("record_id", "string")
    .add("key", "string")
    .add("target_uri", "string")
    .add("date", "string")
    .add("payload_digest", "string")
    .add("payload_bytes", "long")
    .add("refers_to", "string")
)
_ARROW = pa.schema([(f.name, pa.int64() if f.dataType == T.LongType() else pa.string()) for f in HEADERS])


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def _http_head(length: int) -> bytes:
    return b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One record; fields without a value are left out."""
    lines = [f"{name}: {value}".encode() for name, value in fields if value is not None]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join([VERSION, *lines, b"", block, b"", b""])


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """The fields of a record, names in lower case, and its block."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not first.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines:
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields, rest[: int(fields["content-length"])]


def members(raw: bytes) -> Iterator[bytes]:
    """The decompressed gzip members of a file."""
    view, at = memoryview(raw), 0
    while at < len(view):
        unzip, parts = zlib.decompressobj(31), []
        while not unzip.eof:
            if at >= len(view):
                raise ValueError("a record is cut off")
            piece = view[at : at + _READ_BYTES]
            parts.append(unzip.decompress(piece))
            at += len(piece) - len(unzip.unused_data)
        yield b"".join(parts)


class _Writer:
    """Writes records into files of one task; rows for closed files are in ``done``."""

    def __init__(self, folder: str):
        from pyspark import TaskContext

        task = TaskContext.get()
        self.name = f"{task.partitionId():06d}-{task.taskAttemptId()}"
        self.folder, self.out, self.done, self.files = folder, None, [], 0

    def put(self, raw: bytes) -> None:
        if self.out is None:
            store, root = _store(self.folder)
            store.create_dir(root)
            self.file = f"{self.name}-{self.files:05d}.warc.gz"
            self.out = store.open_output_stream(f"{root}/{self.file}")
            self.records = self.bytes = 0
        zipper = zlib.compressobj(wbits=31)
        zipped = zipper.compress(raw) + zipper.flush()
        self.out.write(zipped)
        self.records += 1
        self.bytes += len(zipped)
        if self.bytes >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.file}", self.records, self.bytes))
            self.out, self.files = None, self.files + 1

    def rows(self) -> pa.RecordBatch:
        done, self.done = self.done, []
        columns = [pa.array([row[i] for row in done], kind) for i, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, ["file", "records", "bytes"])


def new_id(folder: str, source: str) -> str:
    """The id in the archives of ``folder`` of the record that ``source`` names."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{folder}#{source}')}>"


def _response(own: str, date: str, key: str | None, uri: str, digest: str, payload: bytes) -> bytes:
    fields = [("WARC-Type", "response"), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri)]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Row-Key", key), ("Content-Type", HTTP_TYPE)]
    return record(fields, _http_head(len(payload)) + payload)


def _revisit(own: str, date: str, key: str | None, uri: str, digest: str, size: int, refers: tuple) -> bytes:
    fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", own), ("WARC-Date", date), ("WARC-Target-URI", uri)]
    fields += [("WARC-Profile", REVISIT_PROFILE), *zip(("WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date"), refers)]
    fields += [("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Row-Key", key), ("Content-Type", HTTP_TYPE)]
    return record(fields, _http_head(size))


def capture(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Write a response record for each row below ``folder``; the stored table of files (file, records, bytes)."""
    date = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, number = _Writer(folder), 0
        for batch in slices(batches, "p"):
            for k, u, p in zip(*(batch[c].to_pylist() for c in ("k", "u", "p"))):
                p = p or b""
                uri = "about:blank" if u is None else quote(u, safe=_SAFE)
                own = new_id(folder, f"{writer.name}-{number}")
                writer.put(_response(own, date, k, uri, hashlib.sha256(p).hexdigest(), p))
                number += 1
            yield writer.rows()
        writer.close()
        yield writer.rows()

    columns = [F.col(key).cast("string").alias("k"), F.col(url).cast("string").alias("u"), F.col(payload).cast("binary").alias("p")]
    return cut_lineage(pages.select(*columns).mapInArrow(tidy(run), FILES))


def _read(file: str) -> Iterator[tuple[dict[str, str], bytes, str, int]]:
    """Fields, payload, digest and full length of the payload of each record of a file."""
    store, name = _store(file)
    with store.open_input_stream(name) as source:
        raw = source.read()
    for member in members(raw):
        fields, block = parse(member)
        head, _, payload = block.partition(b"\r\n\r\n")
        digest = fields["warc-payload-digest"].removeprefix("sha256:")
        if fields["warc-type"] == "response":
            if hashlib.sha256(payload).hexdigest() != digest:
                raise ValueError(f"{file}: a payload differs from its digest")
            size = len(payload)
        else:
            size = int(head.lower().rpartition(b"content-length:")[2].split(b"\r\n")[0])
        yield fields, payload, digest, size


def _tasks(files: DataFrame) -> int:
    return max(1, min(files.count(), 100_000))


def headers(files: DataFrame) -> DataFrame:
    """A row for each record of the files: ``HEADERS``. Payloads of responses are checked against their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def made() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_ARROW)], schema=_ARROW)

        for batch in batches:
            for file in batch["file"].to_pylist():
                for number, (fields, _, digest, size) in enumerate(_read(file)):
                    named = [fields.get(n) for n in ("warc-type", "warc-record-id", "x-row-key", "warc-target-uri", "warc-date")]
                    rows.append((file, number, *named, digest, size, fields.get("warc-refers-to")))
                    if len(rows) == _HEADERS_PER_BATCH:
                        yield made()
                        rows.clear()
        if rows:
            yield made()

    return files.select("file").repartition(_tasks(files), "file").mapInArrow(tidy(run), HEADERS)


def originals(heads: DataFrame, least: int, key_type: str) -> DataFrame:
    """(payload_digest, payload_bytes, original) of payloads that more than one record holds and that have a response."""
    key = F.col("key").cast(key_type)
    own = F.struct(key.isNull().alias("none"), key.alias("typed"), "file", "number", "record_id", "target_uri", "date")
    response = F.when(F.col("record_type") == "response", own)
    groups = heads.filter(F.col("payload_bytes") >= least).groupBy("payload_digest", "payload_bytes")
    return groups.agg(F.count("*").alias("copies"), F.min(response).alias("original")).filter("copies > 1 and original is not null").drop("copies")


def deduplicate(files: DataFrame, folder: str, least: int = LEAST_REVISIT, key_type: str = "bigint") -> DataFrame:
    """Write the records of ``files`` anew below ``folder``, copies as revisits; the stored table of files.

    ``key_type``: the type by which keys are compared for the smallest.
    """
    heads = cut_lineage(headers(files))
    first = cut_lineage(originals(heads, least, key_type))
    same = (F.col("original.file") == F.col("file")) & (F.col("original.number") == F.col("number"))
    refers = [F.when(~same, F.col(f"original.{c}")).alias(f"r_{c}") for c in ("record_id", "target_uri", "date")]
    planned = heads.join(first, ["payload_digest", "payload_bytes"], "left").select("file", "number", *refers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, at, source = _Writer(folder), None, iter(())
        for batch in batches:
            for file, number, r_id, r_uri, r_date in zip(*(batch[c].to_pylist() for c in batch.schema.names)):
                if file != at:
                    at, source = file, enumerate(_read(file))
                place, (fields, payload, digest, size) = next(source)
                if place != number:
                    raise ValueError(f"{file}: record {place} in place of {number}")
                own = (new_id(folder, fields["warc-record-id"]), fields["warc-date"], fields.get("x-row-key"), fields["warc-target-uri"], digest)
                if r_id is not None:
                    writer.put(_revisit(*own, size, (new_id(folder, r_id), r_uri, r_date)))
                elif fields["warc-type"] == "response":
                    writer.put(_response(*own, payload))
                else:
                    old = [fields.get(n) for n in ("warc-refers-to", "warc-refers-to-target-uri", "warc-refers-to-date")]
                    writer.put(_revisit(*own, size, tuple(old)))
            yield writer.rows()
        writer.close()
        yield writer.rows()

    ordered = planned.repartition(_tasks(files), "file").sortWithinPartitions("file", "number")
    return cut_lineage(ordered.mapInArrow(tidy(run), FILES))


def resolve(files: DataFrame) -> DataFrame:
    """The records of the files (``HEADERS``), each revisit with the key of the response it refers to as ``refers_to_key``."""
    heads = cut_lineage(headers(files))
    responses = heads.filter("record_type = 'response'").select(F.col("record_id").alias("refers_to"), F.col("key").alias("refers_to_key"))
    revisits = heads.filter("record_type <> 'response'").join(responses, "refers_to", "left").select(*heads.columns, "refers_to_key")
    return heads.filter("record_type = 'response'").withColumn("refers_to_key", F.lit(None).cast("string")).unionByName(revisits)
