"""Arrow batches cut into slices of bounded text size, for the operators that run Python in tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of each batch whose texts have about `most` bytes together; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        number = np.cumsum(lengths.astype(np.int64)) // most
        starts = np.flatnonzero(np.diff(number, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], batch.num_rows], strict=True):
            yield batch.slice(start, stop - start)


def texts(batch: pa.RecordBatch, name: str) -> list[str]:
    """The texts of a column, an empty one for null."""
    return [value or "" for value in batch.column(name).to_pylist()]
