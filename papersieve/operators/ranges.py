"""Splitting a search into date segments that stay below a result limit."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Results per search, years per segment, days of the year rule.
RESULT_LIMIT = 9_999
CHUNK_YEARS = 3
YEAR_SPAN_DAYS = 365 * CHUNK_YEARS
MONTH_SPAN_DAYS = 28


def month_segments(ranges: DataFrame, start: str = "date_from", end: str = "date_to") -> DataFrame:
    """One row per calendar month of each range, clipped to the range."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    each = ranges.withColumn("_month", F.explode(months))
    return each.select(
        *ranges.columns,
        F.greatest(F.col(start), F.col("_month")).alias("segment_from"),
        F.least(F.col(end), F.last_day("_month")).alias("segment_to"),
    )


def chunk_start(day: Column, first: Column) -> Column:
    """First day of the three-year chunk that holds ``day``; chunks count from ``first``."""
    chunk = F.floor((F.year(day) - F.year(first)) / CHUNK_YEARS)
    begin = F.make_date((F.year(first) + chunk * CHUNK_YEARS).cast("int"), F.lit(1), F.lit(1))
    return F.greatest(begin, first)


def plan_segments(daily: DataFrame, limit: int = RESULT_LIMIT) -> DataFrame:
    """Segments per query from its result counts per day ``(query, day, n)``.

    A query within the limit stays whole; a longer one is cut into three-year
    chunks (if it spans more than that), and a chunk over the limit into months.
    A month over the limit is marked ``truncated``. Days join their segments by
    computed keys, so there is no range join.
    """
    spans = daily.groupBy("query").agg(
        F.min("day").alias("first"), F.max("day").alias("last"), F.sum("n").alias("total")
    )
    by_month = daily.groupBy("query", F.trunc("day", "month").alias("month")).agg(F.sum("n").alias("n"))
    placed = by_month.join(spans, "query").withColumn(
        "chunk",
        F.when(
            F.datediff("last", "first") > YEAR_SPAN_DAYS,
            chunk_start(F.greatest("month", "first"), F.col("first")),
        ).otherwise(F.col("first")),
    )
    chunks = placed.groupBy("query", "chunk").agg(F.sum("n").alias("chunk_n"))
    sized = placed.join(chunks, ["query", "chunk"])
    whole = F.col("total") <= limit
    level = F.when(whole, F.lit("whole")).when(F.col("chunk_n") <= limit, F.lit("chunk")).otherwise(
        F.lit("month")
    )
    chunk_end = F.least(
        F.col("last"),
        F.make_date((F.year("first") + (F.floor((F.year("chunk") - F.year("first")) / CHUNK_YEARS) + 1)
                     * CHUNK_YEARS - 1).cast("int"), F.lit(12), F.lit(31)),
    )
    chunk_end = F.when(F.datediff("last", "first") > YEAR_SPAN_DAYS, chunk_end).otherwise(F.col("last"))
    keyed = sized.withColumn("level", level).select(
        "query",
        "level",
        F.when(F.col("level") == "whole", F.col("first"))
        .when(F.col("level") == "chunk", F.col("chunk"))
        .otherwise(F.greatest("month", "first"))
        .alias("segment_from"),
        F.when(F.col("level") == "whole", F.col("last"))
        .when(F.col("level") == "chunk", chunk_end)
        .otherwise(F.least(F.last_day("month"), "last"))
        .alias("segment_to"),
        "n",
    )
    return (
        keyed.groupBy("query", "level", "segment_from", "segment_to")
        .agg(F.sum("n").alias("n"))
        .withColumn("truncated", F.col("n") > limit)
    )


def split_months(start: date, end: date) -> list[tuple[date, date]]:
    """The calendar months of a range, clipped to it."""
    out, cursor = [], start
    while cursor <= end:
        following = date(cursor.year + cursor.month // 12, cursor.month % 12 + 1, 1)
        out.append((cursor, min(end, following - timedelta(days=1))))
        cursor = following
    return out


def split_range(start: date, end: date) -> list[tuple[date, date]]:
    """The next finer segments of a range that holds too many results.

    Chunks of years, then months, then halves: a single day comes back alone.
    """
    span = (end - start).days
    if span > YEAR_SPAN_DAYS:
        years = range(start.year, end.year + 1, CHUNK_YEARS)
        return [
            (max(start, date(y, 1, 1)), min(end, date(y + CHUNK_YEARS - 1, 12, 31))) for y in years
        ]
    if span >= MONTH_SPAN_DAYS and (start.year, start.month) != (end.year, end.month):
        return split_months(start, end)
    if span:
        middle = start + timedelta(days=span // 2)
        return [(start, middle), (middle + timedelta(days=1), end)]
    return [(start, end)]
