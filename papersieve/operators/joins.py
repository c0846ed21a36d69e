"""Joins of rows that may repeat a key without bound against one row per key.

The side with one row per key is never skewed, so the adaptive planner may split a hot
partition of the other side over several tasks (``session.DEFAULT_CONF`` lets it do so even
where that costs another shuffle). ``dim`` must hold each key once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Add the values of ``dim`` to the rows; null where the key is not in it."""
    return rows.join(dim, key, "left")


def mark(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Add a boolean column telling whether ``key`` occurs in ``keys`` (distinct)."""
    found = lookup(rows, keys.select(key).withColumn(flag, F.lit(True)), key)
    return found.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def exclude(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose ``key`` does not occur in ``keys`` (distinct)."""
    return rows.join(keys.select(key), key, "left_anti")
