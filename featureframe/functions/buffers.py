"""Numpy views of Arrow binary arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def binary_layout(array: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(data, starts, lengths, valid)`` of a binary array."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if not pa.types.is_large_binary(array.type):
        array = array.cast(pa.large_binary())
    _, offset_buffer, data_buffer = array.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64, len(array) + 1, array.offset * 8)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer else np.empty(0, np.uint8)
    valid = array.is_valid().to_numpy(zero_copy_only=False)
    return data, offsets[:-1], np.diff(offsets), valid


def gather(data: np.ndarray, starts: np.ndarray, width: int) -> np.ndarray:
    """``width`` bytes from every start, as a ``(rows, width)`` matrix."""
    return data[starts[:, None] + np.arange(width)]


def doubles_at(data: np.ndarray, starts: np.ndarray, count: int, dtype: str) -> np.ndarray:
    """``count`` doubles from every start, as a ``(rows, count)`` matrix."""
    return gather(data, starts, count * 8).view(dtype)


def fixed_width_binary(rows: np.ndarray, valid: np.ndarray) -> pa.Array:
    """A binary array of the rows of a byte matrix; invalid rows become null."""
    count, width = rows.shape
    lengths = np.where(valid, width, 0)
    offsets = np.zeros(count + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    data = np.ascontiguousarray(rows[valid]).tobytes()
    validity = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
    buffers = [validity, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.binary(), count, buffers)
