"""What the operators share: reading tables and arrays of texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..arrow import SLICE_BYTES, release_memory, slices, tidy  # noqa: F401
from ..session import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts and where each begins (null: empty)."""
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    raw = texts.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(raw[1], np.int64, n + 1, offset=8 * texts.offset)
    data = np.frombuffer(raw[2], np.uint8)[at[0] : at[-1]] if raw[2] is not None else np.zeros(0, np.uint8)
    return data, at - at[0]


def rows_where(rows: DataFrame, text: str, test: Callable[[pa.Array], np.ndarray], most: int = SLICE_BYTES) -> DataFrame:
    """The rows, with all their columns, whose text passes a test that works on arrays of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text, most):
            yield batch.filter(pa.array(test(batch.column(batch.schema.get_field_index(text))), pa.bool_()))

    return rows.mapInArrow(tidy(run), rows.schema)


def without(rows: DataFrame, listed: DataFrame, key: str, most_bytes: int = 16 << 20) -> DataFrame:
    """The rows whose ``key`` is not in the column ``key`` of ``listed``; a null key is in no list.

    The list is sent to the rows where it takes at most ``most_bytes``, by its count; else both are shuffled by the key.
    """
    listed = cut_lineage(listed.select(F.col(key).alias("_listed")).filter("_listed is not null").distinct())
    small = listed.count() * 32 <= most_bytes
    return rows.join(F.broadcast(listed) if small else listed, rows[key] == F.col("_listed"), "left_anti")
