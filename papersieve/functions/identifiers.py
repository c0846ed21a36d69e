"""DOI handling and content signatures."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import SPACE, strip

DOI_PREFIX = r"^(?i:https?://(?:dx\.)?doi\.org/|doi:)"
DOI_FORM = rf"^10\.\p{{Nd}}{{4,9}}/[^{SPACE}]+$"
DOI_MIN_LENGTH = 8


def normalize_doi(doi: Column) -> Column:
    """Strip, drop one resolver or ``doi:`` prefix, lower-case, strip again."""
    bare = F.regexp_replace(strip(F.coalesce(doi, F.lit(""))), DOI_PREFIX, "")
    return strip(F.lower(bare))


def is_valid_doi(doi: Column) -> Column:
    return F.coalesce(doi.rlike(DOI_FORM) & (F.length(doi) >= DOI_MIN_LENGTH), F.lit(False))


def list_signature(dois: Column) -> Column:
    """First 16 hex digits of sha256 over the sorted distinct DOIs, one per line.

    ``dois`` is an array column, so use it for lists of bounded size such as one
    screening batch. For whole tables see ``table_signature``.
    """
    kept = F.filter(F.array_sort(F.array_distinct(dois)), lambda d: d != "")
    return F.substring(F.sha2(F.array_join(kept, "\n"), 256), 1, 16)


def table_signature(df: DataFrame, doi: Column) -> DataFrame:
    """One-row signature of the set of DOIs in a table of any size.

    A sha256 over one joined string would pull every DOI into one task. This
    adds up two 48-bit limbs of each distinct DOI's sha256, which combines
    map-side and does not depend on order, and hashes count and sums.
    """
    digest = F.sha2(F.col("_doi"), 256)
    limb = lambda start: F.conv(F.substring(digest, start, 12), 16, 10).cast("decimal(38,0)")
    totals = (
        df.select(normalize_doi(doi).alias("_doi"))
        .filter(F.col("_doi") != "")
        .distinct()
        .agg(
            F.count("*").alias("record_count"),
            F.coalesce(F.sum(limb(1)), F.lit(0).cast("decimal(38,0)")).alias("_a"),
            F.coalesce(F.sum(limb(13)), F.lit(0).cast("decimal(38,0)")).alias("_b"),
        )
    )
    joined = F.concat_ws("|", F.col("record_count"), F.col("_a"), F.col("_b"))
    return totals.select(
        "record_count", F.substring(F.sha2(joined, 256), 1, 16).alias("signature")
    )


def query_signature(queries: Sequence[str], date_from: str, date_to: str) -> str:
    """Signature of an ordered query list and its window (driver-side, list is config)."""
    raw = f"{date_from}|{date_to}|" + "\n".join(queries)
    return hashlib.sha256(raw.encode()).hexdigest()[:16]


def query_signature_column(queries: Column, date_from: Column, date_to: Column) -> Column:
    """The same signature for an array column of queries."""
    raw = F.concat(date_from, F.lit("|"), date_to, F.lit("|"), F.array_join(queries, "\n"))
    return F.substring(F.sha2(raw, 256), 1, 16)
