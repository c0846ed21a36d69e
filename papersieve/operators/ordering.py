"""Global order without a single-task window: numbering and fixed-size batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_LOCAL_BITS = 33


def number_rows(df: DataFrame, order: list[Column], name: str = "row_index") -> DataFrame:
    """Zero-based position of every row in a total order.

    Rows are range-partitioned and sorted; each partition numbers its own rows,
    and the partitions' starting points come from their row counts. Only those
    counts, one row per partition, meet in one place.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = cut_lineage(placed)
    part = F.shiftright("_place", _LOCAL_BITS)
    local = F.col("_place").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local)
        .drop("_place", "_part", "_start")
    )


def batches(df: DataFrame, order: list[Column], size: int, name: str = "batch_id") -> DataFrame:
    """Consecutive batches of ``size`` rows of the order."""
    if size < 1:
        raise ValueError("batch size must be positive")
    numbered = number_rows(df, order)
    return numbered.withColumn(name, F.floor(F.col("row_index") / size))


def head(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    """First ``n`` rows of an order; no limit for None, zero or a negative number."""
    ordered = df.orderBy(*order)
    return ordered.limit(n) if n and n > 0 else ordered
