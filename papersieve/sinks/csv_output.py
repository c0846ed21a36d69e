"""Run outputs: sanitised CSV per track, combined file, key results, summary."""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.text import sanitize
from ..operators.classify import resolved_track
from ..operators.filters import is_usable
from ..schema import MINIMAL_OUTPUT, TRACKS, with_columns_default
from ..sources.csv_files import BOM

# File names of a run and of its key results.
TRACK_FILES = {
    "pathway": "pathway.csv",
    "enzymatic": "synthesis_enzymatic.csv",
    "fermentation": "synthesis_fermentation.csv",
    "chemical": "synthesis_chemical.csv",
    "hybrid": "synthesis_hybrid.csv",
    "gce": "gce.csv",
}
KEY_FILES = {
    "pathway": "关键_代谢通路.csv",
    "enzymatic": "关键_酶法合成.csv",
    "fermentation": "关键_生物发酵.csv",
    "chemical": "关键_化学合成.csv",
    "hybrid": "关键_酶化学联用.csv",
    "gce": "关键_遗传密码扩展.csv",
}
KEY_ALL_FILE = "关键_全部可用文献.csv"
SUMMARY_FILE = "关键结果汇总.json"
TIME_FORMAT = "%Y-%m-%d %H:%M:%S"


def output_table(records: DataFrame, columns: Sequence[str], fetched_at: str | None, keep: Sequence[str] = ()) -> DataFrame:
    """Projection to the output columns: missing ones blank, all cells sanitised; ``keep`` stays as it is."""
    names = [c for c in columns if c != "fetched_at" or fetched_at is None]
    cells = [
        (sanitize(F.col(c)) if c in records.columns else F.lit("")).alias(c) for c in names
    ]
    if fetched_at is not None:
        cells.append(F.lit(fetched_at).alias("fetched_at"))
    return records.select(*cells, *keep)


def write_csv(table: DataFrame, path: str, bom: bool = True, mode: str = "errorifexists") -> None:
    """A folder of CSV parts; each part has a header and, if asked, a byte order mark.

    Quoting is minimal and quotes are doubled, so a cell may hold line breaks.
    """
    first = table.columns[0]
    named = table.withColumnRenamed(first, BOM + first) if bom else table
    _csv_options(named).mode(mode).csv(path)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def run_dir(spark: SparkSession, output_dir: str, now: datetime, pattern: str = "%Y-%m-%d") -> str:
    """Folder of a run: the day, or day and time if the day already has a run."""
    path = f"{output_dir.rstrip('/')}/{now.strftime(pattern)}"
    return f"{path}_{now.strftime('%H%M%S')}" if exists(spark, path) else path


def _csv_options(table: DataFrame) -> DataFrameWriter:
    return (
        table.write.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .option("lineSep", "\n")
    )


def write_named(table: DataFrame, part: str, targets: Mapping[str, str], beside: str, needed: bool = False) -> bool:
    """Write each row to the CSV folders that its array column ``part`` names, all in one pass over the table.

    ``targets`` maps names to folders. The rows are written below a hidden folder beside the outputs, a folder per name; when
    all of them are there, each is renamed to its target, so a run that dies leaves no half of a file. A name without rows gets a header alone. If
    the table is empty, nothing is written, unless it is ``needed``; whether something was written comes back.
    """
    spark = table.sparkSession
    hidden = f"{beside.rstrip('/')}/_writing-{uuid.uuid4().hex[:12]}"
    cells = [c for c in table.columns if c != part]
    named = [F.col(f"`{c}`").alias(BOM + c if i == 0 else c) for i, c in enumerate(cells)]
    _csv_options(table.select(*named, F.explode(part).alias("_file"))).partitionBy("_file").csv(hidden)
    jvm = spark.sparkContext._jvm
    path = lambda name: jvm.org.apache.hadoop.fs.Path(name)
    files = path(hidden).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = [status.getPath().getName() for status in files.listStatus(path(hidden))]
    filled = {name for name in targets if f"_file={name}" in there}
    written = needed or any(name.startswith("_file=") for name in there)
    for name, target in targets.items() if written else ():
        if name in filled:
            files.mkdirs(path(target).getParent())
            if not files.rename(path(f"{hidden}/_file={name}"), path(target)):
                raise OSError(f"{target} cannot be put in place")
        else:
            line = io.StringIO()
            csv.writer(line, lineterminator="\n").writerow(cells)
            write_text(spark, f"{target}/part-00000.csv", BOM + line.getvalue())
    files.delete(path(hidden), True)
    return written


def write_run(
    records: DataFrame,
    output_dir: str,
    cfg: Mapping | None = None,
    now: datetime | None = None,
) -> str | None:
    """One CSV per track (empty tracks included), optionally all records in one table, in one pass over the records."""
    cfg, now = cfg or {}, now or datetime.now()
    spark = records.sparkSession
    folder = run_dir(spark, output_dir, now, cfg.get("run_dir_pattern", "%Y-%m-%d"))
    names = {**TRACK_FILES, **(cfg.get("track_filenames") or {})}
    targets = {track: f"{folder}/{names[track]}" for track in TRACKS}
    extra = []
    if cfg.get("save_combined_in_run_dir", False):
        targets["all"] = f"{folder}/{cfg.get('combined_filename', 'all.csv')}"
        extra.append("all")
    if cfg.get("save_legacy_flat_file", False):
        targets["flat"] = f"{output_dir.rstrip('/')}/{now.strftime(cfg.get('filename_pattern', 'new_dois_%Y-%m_%H%M%S.csv'))}"
        extra.append("flat")
    bucket = resolved_track()
    files = F.array(bucket, *map(F.lit, extra)).alias("_files")
    marked = with_columns_default(records, ("track", "ai_category")).select("*", files)
    table = output_table(marked, list(cfg.get("columns") or MINIMAL_OUTPUT), now.strftime(TIME_FORMAT), keep=("_files",))
    return folder if write_named(table, "_files", targets, output_dir, bool(cfg.get("save_empty_result", False))) else None


def write_partitioned(records: DataFrame, path: str, mode: str = "overwrite") -> None:
    """All tracks in one pass, partitioned by track; the form to use for large runs."""
    named = with_columns_default(records, ("track", "ai_category"))
    bucketed = named.withColumn("bucket", resolved_track())
    bucketed.write.mode(mode).partitionBy("bucket").parquet(path)


def write_text(spark: SparkSession, path: str, body: str) -> None:
    """A small file through the Hadoop file system, replaced in one step."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    temporary = jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    fs = target.getFileSystem(conf)
    stream = fs.create(temporary, True)
    stream.write(bytearray(body, "utf-8"))
    stream.close()
    fs.delete(target, False)
    fs.rename(temporary, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    return "\n".join(r["value"] for r in spark.read.text(path).collect())


def export_key_results(
    screened: DataFrame, output_dir: str, label: str | None = None, source: str = ""
) -> dict:
    """Usable records per track, all of them, and a summary with counts.

    The input is read once: all files are written and everything is counted in one pass.
    """
    spark = screened.sparkSession
    now = datetime.now()
    folder = f"{output_dir.rstrip('/')}/key_results/{label or now.strftime('%Y-%m-%d_%H%M%S')}"
    seen, passing = Observation("input"), Observation("usable")
    columns = list(screened.columns)
    usable = screened.observe(seen, F.count(F.lit(1)).alias("rows")).filter(is_usable()).withColumn("_bucket", resolved_track())
    counted = [F.count_if(F.col("_bucket") == track).alias(track) for track in TRACKS]
    usable = usable.observe(passing, *counted).withColumn("_files", F.array("_bucket", F.lit("all")))
    files = {track: f"{folder}/{name}" for track, name in KEY_FILES.items()} | {"all": f"{folder}/{KEY_ALL_FILE}"}
    write_named(output_table(usable, columns, None, keep=("_files",)), "_files", files, output_dir, needed=True)
    counts = {track: passing.get[track] for track in TRACKS}
    summary = {
        "generated_at": now.isoformat(timespec="seconds"),
        "source_csv": source,
        "total_input": seen.get["rows"],
        "total_usable": sum(counts.values()),
        "by_track": counts,
        "output_dir": folder,
        "files": files,
    }
    write_text(spark, f"{folder}/{SUMMARY_FILE}", json.dumps(summary, ensure_ascii=False, indent=2))
    files["summary"] = f"{folder}/{SUMMARY_FILE}"
    return summary
