"""What Python tasks share: slicing Arrow batches of texts, and giving memory back."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

# Most text bytes that a task handles at once; a longer single text is handled alone.
SLICE_BYTES = 1 << 20


def release_memory() -> None:
    """Give memory that is free, but still held by the allocators of Arrow and the C library, back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches that releases memory when its task ends: Python workers outlive tasks and steps."""

    @functools.wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return tidied


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with about ``most`` bytes of text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        at = np.concatenate([[0], np.cumsum(_sizes(column))])
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(at, at[row] + most, "right")) - 1)
            yield batch.slice(row, end - row)
            row = end


def _sizes(column: pa.Array) -> np.ndarray:
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
