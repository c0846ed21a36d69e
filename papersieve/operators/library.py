"""Second way in: records of an existing library, by its DOI list and metadata."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_year, year_in_range
from ..functions.identifiers import normalize_doi
from ..functions.text import strip
from ..schema import SEQ, text
from .classify import has_marker, track_of_title


# Copies of a listed DOI that one row makes; its other copies are made by other rows, which are dealt out.
COPIES_PER_BLOCK = 100_000


def library_with_metadata(
    master: DataFrame, metadata: DataFrame, on: str = "DOI", unique: str | None = None
) -> DataFrame:
    """Inner join on the DOI as written; a DOI listed n times yields n rows.

    Only the DOI of the library list is used, so the list shrinks to one row per
    DOI with its count before the join, and the copies are made afterwards: each match becomes
    one row per block of copies, the blocks are dealt out, and then the copies are made. A
    DOI that fills a third of the list costs one row in the join. ``unique`` (a unique column of the metadata) deals
    the blocks of a frequent metadata DOI apart.
    """
    counted = master.filter(F.col(on).isNotNull()).groupBy(on).agg(F.count("*").alias("_copies"))
    joined = metadata.filter(F.col(on).isNotNull()).join(counted, on)
    last = F.floor((F.col("_copies") - 1) / COPIES_PER_BLOCK)
    blocks = joined.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    dealt = blocks.repartition("_block", unique or on)
    first = F.col("_block") * COPIES_PER_BLOCK + 1
    numbers = F.sequence(first, F.least(first + (COPIES_PER_BLOCK - 1), F.col("_copies")))
    return dealt.withColumn("_copy", F.explode(numbers)).drop("_copies", "_block")


def scan_library(
    master: DataFrame,
    metadata: DataFrame,
    *,
    on: str = "DOI",
    unique: str | None = None,
    date_from: str | None = None,
    date_to: str | None = None,
    all_years: bool = False,
) -> DataFrame:
    """Library records whose title carries a marker and whose year fits.

    The title and year tests need only the metadata, so they run before the join.
    """
    title = strip(text("title"))
    candidates = metadata.filter(has_marker(title))
    if not all_years:
        candidates = candidates.filter(year_in_range(parse_year(F.col("year")), date_from, date_to))
    keep = [c for c in (SEQ,) if c in metadata.columns]
    # The record is complete before the join, so copies cost no further work.
    prepared = candidates.select(
        *keep,
        F.col(on).alias("_listed"),
        normalize_doi(F.col(on)).alias("doi"),
        title.alias("title"),
        F.lit("master_library").alias("source"),
        track_of_title(title).alias("track"),
        F.lit("").alias("pmid"),
        strip(text("journal")).alias("journal"),
        strip(text("year")).alias("pub_date"),
        F.lit("").alias("publication_types"),
        F.lit("").alias("abstract"),
        F.lit("true").alias("local_has_pdf"),
    ).filter(F.col("doi") != "")
    listed = master.select(F.col(on).alias("_listed"))
    return library_with_metadata(listed, prepared, "_listed", unique).drop("_listed")
