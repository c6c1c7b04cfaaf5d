"""Views on the cells of an Arrow binary column, without copying."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def binary_cells(column: pa.Array) -> Iterator[np.ndarray]:
    """One uint8 view per row; a null row gives an empty view."""
    wide = pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for start, end in zip(offsets[:-1], offsets[1:]):
        yield values[start:end]


def hist_matrix(column: pa.Array) -> np.ndarray:
    """Rows x 256 counts from a list column of dense histograms."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat, np.int64).reshape(len(column), 256)
