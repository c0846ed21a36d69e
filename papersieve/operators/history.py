"""Known DOIs: where they come from, and joins against them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import normalize_doi
from ..schema import text
from ..session import is_missing
from ..sources.csv_files import RUN_FILE_NAMES, doi_column, read_by_layout, read_csv, run_files
from . import joins


def empty_dois(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doi string")


def known_dois(table: DataFrame, column: str | Column = "doi") -> DataFrame:
    """Distinct normalised DOIs of a table, blanks dropped."""
    source = F.col(column) if isinstance(column, str) else column
    return (
        table.select(normalize_doi(source.cast("string")).alias("doi"))
        .filter(F.col("doi") != "")
        .distinct()
    )


def union_dois(parts: Iterable[DataFrame]) -> DataFrame:
    """Union of several DOI tables as a set (one shuffle for all of them)."""
    return reduce(DataFrame.unionByName, [p.select("doi") for p in parts]).distinct()


def dois_of_csv(spark: SparkSession, path: str, preferred: str = "DOI") -> DataFrame:
    """Known DOIs of one CSV source. A path that is not there and a table without a DOI column have none; any
    other failure is raised, as an empty list would let duplicates through."""
    try:
        table = read_csv(spark, path)
    except AnalysisException as error:
        if not is_missing(error):
            raise
        return empty_dois(spark)
    return dois_of_table(table, preferred)


def dois_of_table(table: DataFrame, preferred: str) -> DataFrame:
    """Known DOIs of a table; one without a DOI column has none."""
    try:
        name = doi_column(table.columns, preferred)
    except KeyError:
        return empty_dois(table.sparkSession)
    return known_dois(table, F.col(f"`{name}`"))


def dois_of_runs(
    spark: SparkSession, output_dir: str, pattern: str, preferred: str = "doi", names: Iterable[str] = RUN_FILE_NAMES
) -> DataFrame:
    """Known DOIs of the files earlier runs wrote below ``output_dir``: one scan for each order of columns among them."""
    paths = run_files(spark, output_dir, pattern, names)
    if not paths:
        return empty_dois(spark)
    tables = read_by_layout(spark, paths)
    return union_dois([empty_dois(spark), *(dois_of_table(t, preferred) for t in tables)])


def known_from_config(
    spark: SparkSession, paths: Mapping, dedup: Mapping, track_files: Mapping | None = None
) -> DataFrame:
    """Master list, extra lists and earlier outputs, each if switched on. ``track_files``: configured file names by track."""
    parts = [empty_dois(spark)]
    if dedup.get("use_master_csv", True) and paths.get("master_csv"):
        parts.append(dois_of_csv(spark, paths["master_csv"], paths.get("master_doi_column", "DOI")))
    for extra in paths.get("extra_doi_csvs") or []:
        if str((extra or {}).get("path") or "").strip():
            parts.append(dois_of_csv(spark, extra["path"], extra.get("doi_column") or "doi"))
    if dedup.get("include_previous_outputs", True) and paths.get("output_dir"):
        parts.append(
            dois_of_runs(
                spark,
                paths["output_dir"],
                dedup.get("previous_output_glob", "new_dois_*.csv"),
                dedup.get("previous_output_doi_column", "doi"),
                {*RUN_FILE_NAMES, *(track_files or {}).values()},
            )
        )
    return union_dois(parts)


def not_known(records: DataFrame, known: DataFrame) -> DataFrame:
    """Records with a DOI that is not known yet; repeated DOIs all stay."""
    keyed = records.withColumn("_doi", normalize_doi(text("doi"))).filter(F.col("_doi") != "")
    dim = known.select(F.col("doi").alias("_doi"))
    return joins.exclude(keyed, dim, "_doi").drop("_doi")


def flag_local(records: DataFrame, known: DataFrame, column: str = "local_has_pdf") -> DataFrame:
    """Add 'true' or 'false': is the DOI in the local library?"""
    keyed = records.withColumn("_doi", normalize_doi(text("doi")))
    dim = known.select(F.col("doi").alias("_doi"))
    marked = joins.mark(keyed, dim, "_doi", "_local")
    flag = F.when(F.col("_local"), F.lit("true")).otherwise(F.lit("false"))
    return marked.withColumn(column, flag).drop("_doi", "_local")
