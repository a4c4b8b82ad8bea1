"""Arrow batches of texts as numpy byte arrays, in slices of bounded size."""

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)


def text_sizes(column: pa.Array) -> np.ndarray:
    offsets = _offsets(column)
    return offsets[1:] - offsets[:-1]


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each slice holds at most ``limit`` bytes of text, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(text_sizes(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and the offsets between them. NULL is empty."""
    offsets = _offsets(column)
    data = _plain(column).buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], offsets - offsets[0]


def _plain(column: pa.Array) -> pa.Array:
    return column if column.type == pa.string() else column.cast(pa.string())


def _offsets(column: pa.Array) -> np.ndarray:
    column = _plain(column)
    if not len(column):
        return np.zeros(1, np.int64)
    raw = np.frombuffer(column.buffers()[1], np.int32)
    return raw[column.offset : column.offset + len(column) + 1].astype(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) * _MIX
        x ^= x >> np.uint64(32)
        x *= _MIX
        x ^= x >> np.uint64(29)
    return x


def hashed_grams(data: np.ndarray, order: int, bits: int) -> np.ndarray:
    """For each position with ``order`` bytes to come, those bytes hashed to ``bits`` bits."""
    n = len(data) - order + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    code = data[:n].astype(np.uint32)
    for i in range(1, order):
        code = (code * np.uint32(257)) ^ data[i : i + n]
        if i >= 3:
            code ^= code >> np.uint32(15)
    code += np.uint32(order)
    code *= np.uint32(0x9E3779B1)
    code ^= code >> np.uint32(16)
    code *= np.uint32(0x85EBCA6B)
    return code >> np.uint32(32 - bits)


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The given names, lengthened where a column has that name already."""
    taken = {column.casefold() for column in columns}
    found = []
    for name in names:
        while name.casefold() in taken:
            name += "_"
        found.append(name)
    return found
