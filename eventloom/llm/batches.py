"""Arrow batches of texts in pieces that are bounded by bytes, so that a worker's memory is."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def slices(batch: pa.RecordBatch, column: int, most_bytes: int) -> Iterator[pa.RecordBatch]:
    """The rows in order, cut where the texts of `column` would pass `most_bytes`; a longer text is a slice of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start = np.cumsum(sizes), 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The UTF-8 bytes of a string column, end to end and not copied, and the limits of its texts; null is empty."""
    filled = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(filled.type) else np.int32
    _, limits, data = filled.buffers()
    if limits is None:
        return memoryview(b""), np.zeros(len(filled) + 1, np.int64)
    at = np.frombuffer(limits, kind)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    whole = memoryview(data) if data is not None else memoryview(b"")
    return whole[at[0] : at[-1]], at - at[0]


def point_starts(data: memoryview) -> np.ndarray:
    """Offsets at which the code points of UTF-8 bytes begin, and the end."""
    at = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((at & 0xC0) != 0x80), len(at))
