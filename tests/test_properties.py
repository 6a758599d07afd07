"""Properties over generated input."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from featureframe.functions.buffers import binary_layout
from featureframe.functions.wkb import encode_points, little_endian
from featureframe.operators.fit import fit
from featureframe.sources import shapefile

settings.register_profile("steady", deadline=None, derandomize=True)
settings.load_profile("steady")

numbers = st.floats(allow_nan=False, allow_infinity=False, width=64)
positions = st.lists(st.tuples(numbers, numbers), min_size=1, max_size=6)


def line(order: str, points: list[tuple]) -> bytes:
    flat = [value for point in points for value in point]
    return struct.pack(f"{order}BII{len(flat)}d", order == "<", 2, len(points), *flat)


def lines(order: str, parts: list[list[tuple]], inner: str) -> bytes:
    return struct.pack(f"{order}BII", order == "<", 5, len(parts)) + b"".join(line(inner, part) for part in parts)


@given(st.lists(positions, min_size=1, max_size=4))
def test_any_byte_order_becomes_the_same_geometry(parts):
    plain = lines("<", parts, "<")
    for order, inner in (("<", "<"), (">", ">"), (">", "<"), ("<", ">")):
        assert little_endian(lines(order, parts, inner)) == plain


@given(st.lists(st.one_of(st.none(), st.tuples(numbers, numbers)), max_size=20))
def test_points_encode_like_struct(points):
    valid = np.array([point is not None for point in points], dtype=bool)
    x, y = (np.array([point[i] if point else 0.0 for point in points]) for i in (0, 1))
    expected = [struct.pack("<BIdd", 1, 1, *point) if point else None for point in points]
    assert encode_points(x, y, valid).to_pylist() == expected


@given(st.lists(st.one_of(st.none(), st.binary(max_size=9)), max_size=20), st.integers(0, 5))
def test_layout_of_sliced_binary_arrays(values, skip):
    array = pa.array(values, pa.binary())[skip:]
    data, starts, lengths, valid = binary_layout(array)
    seen = [
        data[start : start + length].tobytes() if ok else None for start, length, ok in zip(starts, lengths, valid)
    ]
    assert seen == values[skip:]


@given(st.lists(st.one_of(st.none(), st.integers(), st.text(max_size=5), st.floats(), st.binary(max_size=3))))
def test_fit_never_fails_and_keeps_the_length(values):
    for target in (pa.int16(), pa.int64(), pa.float32(), pa.float64(), pa.string(), pa.bool_(), pa.date32()):
        fitted = fit(values, target)
        assert (len(fitted), fitted.type) == (len(values), target)
        assert all(new is None for old, new in zip(values, fitted.to_pylist()) if old is None)


@settings(max_examples=50)
@given(st.integers(0, 40), st.integers(0, 40), st.lists(st.integers(4, 500), min_size=40, max_size=40))
def test_cuts_cover_a_range_once(start, stop, sizes):
    class Index:
        def entries(self, low, high):
            return np.array([(0, size) for size in sizes[low:high]], dtype=np.int64).reshape(-1, 2)

    rows, size = shapefile.BATCH_ROWS, shapefile.BATCH_BYTES
    shapefile.BATCH_ROWS, shapefile.BATCH_BYTES = 16, 700
    try:
        cuts = list(shapefile._cuts(Index(), start, stop))
    finally:
        shapefile.BATCH_ROWS, shapefile.BATCH_BYTES = rows, size
    assert [i for low, high in cuts for i in range(low, high)] == list(range(start, stop))
    assert all(sum(sizes[low:high]) <= 700 + 500 for low, high in cuts)
