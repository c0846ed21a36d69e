"""Record layout shared by every stage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Research tracks in rank order, record and output columns.
TRACKS = ("pathway", "enzymatic", "fermentation", "chemical", "hybrid", "gce")
DEFAULT_TRACK = "pathway"
SOURCES = ("pubmed", "crossref", "master_library")
BASE_COLUMNS = (
    "source",
    "pmid",
    "doi",
    "title",
    "journal",
    "pub_date",
    "abstract",
    "publication_types",
)
MINIMAL_OUTPUT = ("doi", "title", "source", "pmid", "journal", "pub_date")
OUTPUT_COLUMNS = (
    "doi",
    "title",
    "source",
    "track",
    "pmid",
    "journal",
    "pub_date",
    "publication_types",
    "abstract",
    "local_has_pdf",
    "compounds",
    "ai_article_type",
    "lit_type_zh",
    "ai_domain_relevant",
    "ai_has_experiment",
    "ai_pass",
    "ai_rationale_zh",
    "ai_category",
    "ai_synthesis_method",
    "ai_has_pathway_or_synthesis",
    "ai_compound",
    "fetched_at",
)
AI_COLUMNS = (
    "ai_article_type",
    "ai_domain_relevant",
    "ai_has_experiment",
    "ai_pass",
    "ai_rationale_zh",
    "lit_type_zh",
    "ai_category",
    "ai_synthesis_method",
    "ai_has_pathway_or_synthesis",
    "ai_compound",
)

SEQ = "ingest_seq"

RECORD_SCHEMA = T.StructType(
    [T.StructField(SEQ, T.LongType(), False)]
    + [T.StructField(c, T.StringType(), True) for c in BASE_COLUMNS]
    + [T.StructField("track", T.StringType(), True)]
)


def text(name: str) -> Column:
    """A string column with the missing value spelled as the empty string."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def track_rank(track: Column) -> Column:
    """Position in TRACKS; anything else sorts after the last track."""
    rank = F.lit(len(TRACKS))
    for position, name in reversed(list(enumerate(TRACKS))):
        rank = F.when(track == name, F.lit(position)).otherwise(rank)
    return rank


def with_columns_default(df: DataFrame, names, default: str = "") -> DataFrame:
    """Add the missing columns of ``names`` as constant strings."""
    missing = {n: F.lit(default) for n in names if n not in df.columns}
    return df.withColumns(missing) if missing else df


def adopt_columns(df: DataFrame, names) -> DataFrame:
    """Fill our columns from differently named ones of older files.

    ``names`` maps the old name to ours; an old column only fills blank cells.
    """
    for old, ours in (names or {}).items():
        if old not in df.columns:
            continue
        value = F.coalesce(F.col(f"`{old}`").cast("string"), F.lit(""))
        if ours in df.columns:
            own = text(ours)
            value = F.when(own == "", value).otherwise(own)
        df = df.withColumn(ours, value).drop(old)
    return df
