"""Repair and append: lay screened columns over base rows, or add rows to an output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import is_valid_doi, normalize_doi
from ..functions.text import sanitize
from ..schema import SEQ, text
from . import joins
from .dedup import keep_last

# Which columns of a screened output replace those of the base rows.
OVERLAY_PREFIX = "ai_"
OVERLAY_EXACT = ("local_has_pdf", "title_filter_hits", "title_filter_pass", "fetched_at")


def overlay_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith(OVERLAY_PREFIX) or c in OVERLAY_EXACT]


def repair(base: DataFrame, screened: DataFrame, order: str = SEQ) -> DataFrame:
    """Base rows with the screened columns of the last valid screened row of their DOI."""
    names = overlay_columns(screened.columns)
    valid = screened.withColumn("_doi", normalize_doi(text("doi"))).filter(is_valid_doi(F.col("_doi")))
    lasts = keep_last(valid, F.col("_doi"), order)
    side = lasts.select("_doi", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in names])
    keyed = base.withColumn("_doi", normalize_doi(text("doi"))).filter(F.col("_doi") != "")
    joined = joins.lookup(keyed, side, "_doi")

    def cell(name: str) -> Column:
        old = F.col(name) if name in base.columns else F.lit("")
        value = F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(old) if name in names else old
        return value.alias(name) if name == SEQ else sanitize(value).alias(name)

    extra = [c for c in names if c not in base.columns]
    return joined.select(*[cell(c) for c in (*base.columns, *extra)])


def append_rows(base: DataFrame, new: DataFrame, fetched_at: Column) -> DataFrame:
    """All base rows, then the new rows; columns of either side, missing cells blank."""
    stamped = new.select(
        *[sanitize(F.col(c)).alias(c) for c in new.columns if c != "fetched_at"],
        fetched_at.alias("fetched_at"),
    )
    return base.unionByName(stamped, allowMissingColumns=True).fillna("")
