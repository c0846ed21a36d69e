"""Counters of the stages: one aggregation each, combined map-side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..schema import TRACKS


def count_by(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n"))


def kept_dropped(df: DataFrame, dropped: Column) -> DataFrame:
    """One row: input, dropped, kept."""
    return df.agg(
        F.count("*").alias("input"),
        F.count_if(dropped).alias("dropped"),
        F.count_if(~dropped).alias("kept"),
    )


def title_counts(tagged: DataFrame, drop_failed: bool = True) -> DataFrame:
    """One row of title filter counters of a table with hits and pass columns."""
    hits, failed = F.col("title_filter_hits"), F.col("title_filter_pass") == "false"
    dropped = failed if drop_failed else F.lit(False)
    return tagged.agg(
        F.count("*").alias("input"),
        F.count_if(dropped).alias("dropped"),
        F.count_if(~dropped).alias("kept"),
        F.count_if(F.startswith(hits, F.lit("neg:"))).alias("tagged"),
        F.count_if(F.contains(hits, F.lit("pos:missing"))).alias("positive_miss"),
    )


def drop_reason_counts(df: DataFrame, reason: Column) -> DataFrame:
    """Drop reasons with their counts, in alphabetical order; kept rows are left out."""
    counted = df.groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
    return counted.filter(F.col("reason").isNotNull()).orderBy("reason")


def count_by_domain(df: DataFrame, column: Column, domain: Sequence[str] = TRACKS, name: str = "track") -> DataFrame:
    """Counts over a fixed domain, zero where nothing was found."""
    counts = df.agg(*[F.count_if(column == value).alias(value) for value in domain])
    pairs = F.array(*[F.struct(F.lit(v).alias(name), F.col(f"`{v}`").alias("n")) for v in domain])
    return counts.select(F.inline(pairs))


def observed(df: DataFrame, name: str, **conditions: Column) -> tuple[DataFrame, Observation]:
    """Count rows and conditions while the data passes, at no extra pass."""
    observation = Observation(name)
    metrics = [F.count(F.lit(1)).alias("input")]
    metrics += [F.count(F.when(cond, 1)).alias(key) for key, cond in conditions.items()]
    return df.observe(observation, *metrics), observation
