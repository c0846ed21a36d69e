"""Bounded samples of rows for fitting, chosen by a hash of the id, and the folds of the contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STEPS = 1 << 30


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.pmod(F.crc32(key.cast("string")), F.lit(folds))


def outside_fold(rows: DataFrame, folds: int, held: int, key: str = "doc_id") -> DataFrame:
    """The rows that may be learned from: not those of the held-out fold, nor those without an id."""
    return rows.filter(fold(F.col(key), folds) != held)


def sample_by_class(rows: DataFrame, key: str, label: str, most: int, in_all: int | None = None) -> DataFrame:
    """About ``most`` rows of each label, or all if there are fewer; the same ones in every run.

    Only the number of rows of each label reaches the driver. A row is taken if the hash of its whole content
    falls below the label's share, so no label is ever sorted or gathered; rows that repeat are taken together and kept
    once. The expected number is ``most``, or an equal share of ``in_all`` where there are so many labels; its spread is the square root of that.
    """
    rows = rows.filter(F.col(label).isNotNull())
    counts = rows.groupBy(label).count().collect()
    if in_all is not None and counts:
        most = min(most, max(1, in_all // len(counts)))
    place = F.pmod(F.xxhash64(*rows.columns, F.lit("sample")), F.lit(_STEPS))
    share = F.lit(None).cast("long")
    for row in sorted(counts, key=lambda r: str(r[label])):
        share = F.when(F.col(label) == row[label], int(_STEPS * min(1.0, most / row["count"]))).otherwise(share)
    return rows.filter(place < share).distinct()


def sampled_labels(labels: DataFrame, label: str, key: str, most: int) -> DataFrame:
    """(k, y): about ``most`` ids of each label 0 or 1, each id once (marked 1 if any of its rows is)."""
    marked = labels.select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).filter("y in (0, 1) and k is not null")
    return sample_by_class(marked.groupBy("k").agg(F.max("y").alias("y")), "k", "y", most)


def one_text(documents: DataFrame, chosen: DataFrame, key: str, text: str) -> DataFrame:
    """(k, y, t): one text, the smallest, for each chosen id, however often documents repeat it. ``chosen`` (k, y) is bounded."""
    rows = documents.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    return rows.join(F.broadcast(chosen), "k").groupBy("k", "y").agg(F.min("t").alias("t"))
