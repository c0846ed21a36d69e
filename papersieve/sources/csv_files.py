"""CSV inputs and the files of earlier runs."""

from __future__ import annotations

import csv
import fnmatch
import io
import re
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of the files a run writes besides its flat file.
RUN_FILE_NAMES = (
    "pathway.csv",
    "synthesis_enzymatic.csv",
    "synthesis_fermentation.csv",
    "synthesis_chemical.csv",
    "synthesis_hybrid.csv",
    "gce.csv",
    "all.csv",
)
DOI_COLUMN_NAMES = ("doi", "DOI", "Doi")
BOM = "\ufeff"


def read_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A CSV with header, all columns strings, quoted line breaks kept, BOM removed."""
    table = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .option("inferSchema", False)
        .option("nullValue", "")
        .csv(path)
    )
    first = table.columns[0] if table.columns else ""
    return table.withColumnRenamed(first, first.lstrip(BOM)) if first.startswith(BOM) else table


def doi_column(columns: Sequence[str], preferred: str) -> str:
    for name in (preferred, *DOI_COLUMN_NAMES):
        if name in columns:
            return name
    raise KeyError(f"no DOI column {preferred!r} among {list(columns)}")


def _listing(spark: SparkSession, root: str) -> list[tuple[str, str, int]]:
    """(path, name, modification time) of the CSV files and folders below ``root``.

    A folder ``x.csv/`` written by Spark counts as one file.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found, todo = [], [path]
    while todo:
        for status in fs.listStatus(todo.pop()):
            name = status.getPath().getName()
            if name.endswith(".csv"):
                found.append((status.getPath().toString(), name, status.getModificationTime()))
            elif status.isDirectory() and not name.startswith(("_", ".")):
                todo.append(status.getPath())
    return sorted(found)


def run_files(
    spark: SparkSession, output_dir: str, pattern: str, names: Iterable[str] = RUN_FILE_NAMES
) -> list[str]:
    """Files of earlier runs: the pattern at the top, else anywhere below; plus run files."""
    listing = _listing(spark, output_dir)
    root = output_dir.rstrip("/").split("/")[-1]
    top = [p for p, n, _ in listing if fnmatch.fnmatch(n, pattern) and p.split("/")[-2] == root]
    deep = [p for p, n, _ in listing if fnmatch.fnmatch(n, pattern)]
    named = [p for p, n, _ in listing if n in names]
    return list(dict.fromkeys([*(top or deep), *named]))


def latest_run_file(spark: SparkSession, output_dir: str, pattern: str, combined: str = "all.csv") -> str | None:
    """The newest flat file, else the combined file of the newest run folder.

    Newest means the latest modification time: file names need not sort by date.
    Exported results do not count as a run.
    """
    listing = [e for e in _listing(spark, output_dir) if "/key_results/" not in e[0]]
    for wanted in (pattern, combined):
        hits = [(time, path) for path, name, time in listing if fnmatch.fnmatch(name, wanted)]
        if hits:
            return max(hits)[1]
    return None


def _header(path: str) -> list[str]:
    """The first line of a CSV, or of the first part of a folder of CSV parts; none if it is empty."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    if store.get_file_info(name).type == fs.FileType.Directory:
        parts = [i for i in store.get_file_info(fs.FileSelector(name)) if i.size and not i.base_name.startswith(("_", "."))]
        if not parts:
            return []
        name = min(i.path for i in parts)
    with store.open_input_stream(name) as source:
        return next(csv.reader(io.TextIOWrapper(source, "utf-8-sig", newline="")), [])


def headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """The header of each file; the files are opened by tasks, and a line per file comes back."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_header(path) for path in batch["path"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["path"], pa.array(found, pa.list_(pa.string()))], ["path", "names"])

    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    rows = listed.repartition(tasks, "path").mapInArrow(read, "path string, names array<string>").collect()
    return {r["path"]: tuple(r["names"]) for r in rows}


def read_by_layout(spark: SparkSession, paths: Sequence[str]) -> list[DataFrame]:
    """All files as one table for each order of columns that occurs, however many files there are."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path, names in headers(spark, paths).items():
        if names:
            layouts.setdefault(names, []).append(path)
    return [read_csv(spark, sorted(found)) for _, found in sorted(layouts.items())]


def distinct_dois(table: DataFrame, preferred: str) -> DataFrame:
    name = doi_column(table.columns, preferred)
    return table.select(F.col(f"`{name}`").alias("doi")).filter(F.col("doi").isNotNull())
