"""Stretches of numbers in binary columns: one value per row, no overhead per number."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def packed(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Stretches ``values[cuts[i]:cuts[i + 1]]`` as one binary each."""
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """Numbers of all rows, end to end."""
    offsets, values = _offsets(column), column.buffers()[2]
    return np.frombuffer(values, np.uint8)[offsets[0]:offsets[-1]].view(kind) if values is not None else np.zeros(0, kind)


def packed_lengths(column: pa.Array, kind: type) -> np.ndarray:
    """Numbers in each row."""
    return np.diff(_offsets(column)) // np.dtype(kind).itemsize
