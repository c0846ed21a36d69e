"""A sink that lands rows unit by unit, so that what a failing job has finished is kept.

``format("unit_landing")`` takes rows with the columns ``unit`` (the name of a unit of work), ``unit_rows`` (how many rows it
has), ``error`` (null, or why the unit ends here) and the data. Rows of a unit stand together in one task. Each unit becomes a Parquet file of
its own, written under a hidden name and renamed when all of its rows have come: a unit is whole or not there, and one that is written again
replaces itself. A unit with an error or too few rows does not stop the others: each task tells in its commit message what it could not land,
and the job's commit raises when all tasks are done. A job that dies leaves its finished units too; the next one asks ``landed`` for them
and does the rest.

A sink of many small units may let them share files (``UnitWriter.seconds``), so that files grow with the time that a job takes and not with
its units. A file then holds whole units only; a unit that a repeated task writes again is there twice, which their reader has to tell.
"""

from __future__ import annotations

import os
import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

_END = ".parquet"
_CONTROL = ("unit", "unit_rows", "error")
# Bytes of finished units that wait for a shared file at most.
SHARED_BYTES = 8 << 20


@dataclass
class UnitsLanded(WriterCommitMessage):
    """What a task has landed."""

    units: tuple[str, ...]
    failed: tuple[str, ...]


class IncompleteUnits(Exception):
    """Some units ended before all of their rows had come."""


class UnitFailed(Exception):
    """Work on a unit cannot go on."""


def _store(path: str):
    from pyarrow import fs

    place = re.sub(r"^file:/+", "file:///", path)
    return fs.FileSystem.from_uri(place if "://" in place else os.path.abspath(place))


class _OpenUnit:
    """The file of the unit that is being written."""

    def __init__(self, path: str, unit: str, expected: int):
        self.unit, self.expected, self.rows, self.writer = unit, expected, 0, None
        self.store, self.root = _store(path)
        self.hidden = f"{self.root}/.{unit}-{os.getpid()}-{id(self)}"

    def write(self, batch: pa.RecordBatch) -> None:
        import pyarrow.parquet as pq

        if self.writer is None:
            self.store.create_dir(self.root)
            self.out = self.store.open_output_stream(self.hidden)
            self.writer = pq.ParquetWriter(self.out, batch.schema)
        self.writer.write_batch(batch)
        self.rows += batch.num_rows

    def close(self, error: str | None) -> str | None:
        """Put the file in its place, or tell why it is not whole."""
        if self.writer is not None:
            self.writer.close()
            self.out.close()
        if error is None and self.rows != self.expected:
            error = f"{self.rows} of {self.expected} rows"
        if error is None:
            self.store.move(self.hidden, f"{self.root}/{self.unit}{_END}")
        elif self.writer is not None:
            self.store.delete_file(self.hidden)
        return error and f"{self.unit}: {error}"


class _Shared:
    """Finished units of a task that wait for their file, ``seconds`` at most."""

    def __init__(self, path: str, seconds: float):
        self.path, self.seconds, self.held, self.size, self.since = path, seconds, [], 0, time.monotonic()

    def add(self, unit: str, batches: list[pa.RecordBatch]) -> None:
        self.held.append((unit, batches))
        self.size += sum(b.nbytes for b in batches)
        self.land_due()

    def land_due(self) -> None:
        if self.size >= SHARED_BYTES or time.monotonic() - self.since >= self.seconds:
            self.land()

    def land(self) -> None:
        """Put what waits into a file of its own."""
        batches = [b for _, own in self.held for b in own]
        if batches:
            import pyarrow.parquet as pq

            store, root = _store(self.path)
            store.create_dir(root)
            name = f"{self.held[0][0]}-{len(self.held)}-{uuid.uuid4().hex}{_END}"
            with store.open_output_stream(f"{root}/.{name}") as out:
                pq.write_table(pa.Table.from_batches(batches), out)
            store.move(f"{root}/.{name}", f"{root}/{name}")
        self.held, self.size, self.since = [], 0, time.monotonic()


class _SharingUnit:
    """A unit whose rows are kept until it is whole, then handed to the shared file."""

    def __init__(self, shared: _Shared, unit: str, expected: int):
        self.shared, self.unit, self.expected, self.batches = shared, unit, expected, []

    def write(self, batch: pa.RecordBatch) -> None:
        self.batches.append(batch)
        self.shared.land_due()

    def close(self, error: str | None) -> str | None:
        rows = sum(b.num_rows for b in self.batches)
        if error is None and rows != self.expected:
            error = f"{rows} of {self.expected} rows"
        if error is None:
            self.shared.add(self.unit, self.batches)
        return error and f"{self.unit}: {error}"


class UnitWriter(DataSourceArrowWriter):
    """Lands rows as they come, or what ``work`` makes of them."""

    # How long a finished unit may wait for others to share its file (None: each has a file of its own). Such units are held in memory.
    seconds: float | None = None

    def __init__(self, path: str):
        self.path = path

    def work(self, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """What is landed for some rows of a unit, as many rows as came; an ``UnitFailed`` ends the unit."""
        yield rows

    def write(self, iterator: Iterator[pa.RecordBatch]) -> UnitsLanded:
        if self.seconds is None:
            return self._write(iterator, lambda name, count: _OpenUnit(self.path, name, count))
        shared = _Shared(self.path, self.seconds)
        try:
            return self._write(iterator, lambda name, count: _SharingUnit(shared, name, count))
        finally:
            shared.land()

    def _write(self, iterator: Iterator[pa.RecordBatch], begin) -> UnitsLanded:
        unit, error, done, failed = None, None, [], []

        def finish() -> None:
            if unit is not None:
                lost = unit.close(error)
                done.append(unit.unit) if lost is None else failed.append(lost)

        for batch in iterator:
            names, counts, errors = (batch.column(c).to_pylist() for c in _CONTROL)
            data = batch.select([c for c in batch.schema.names if c not in _CONTROL])
            cuts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
            for a, b in zip(cuts, [*cuts[1:], len(names)]):
                if unit is None or names[a] != unit.unit:
                    finish()
                    unit, error = begin(names[a], counts[a]), None
                error = error or next((e for e in errors[a:b] if e is not None), None)
                try:
                    for made in self.work(data.slice(a, b - a)) if error is None else ():
                        unit.write(made)
                except UnitFailed as failure:
                    error = str(failure)
        finish()
        return UnitsLanded(tuple(done), tuple(failed))

    def commit(self, messages: list[UnitsLanded | None]) -> None:
        failed = [f for m in messages if m is not None for f in m.failed]
        if failed:
            raise IncompleteUnits(f"{len(failed)} units are missing: " + "; ".join(failed[:20]))


class UnitLanding(DataSource):
    """``path``: the folder of the units."""

    @classmethod
    def name(cls) -> str:
        return "unit_landing"

    def writer(self, schema, overwrite: bool) -> UnitWriter:
        return UnitWriter(self.options["path"])


def land(rows: DataFrame, path: str, sink: type[UnitLanding] = UnitLanding) -> None:
    """Land the rows (unit, unit_rows, error, data), or what the sink makes of them, below ``path``."""
    rows.sparkSession.dataSource.register(sink)
    rows.write.format(sink.name()).option("path", path).mode("append").save()


def folders(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if it is not there."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in files.listStatus(folder)] if files.exists(folder) else []


def landed(spark: SparkSession, path: str) -> set[str]:
    """The names of the units below ``path``."""
    return {name.removesuffix(_END) for name in folders(spark, path) if name.endswith(_END) and not name.startswith(".")}


def names(schema: str) -> list[str]:
    """The column names of a schema in words."""
    return [column.split()[0] for column in schema.split(",")]


def read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of all landed units."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)
