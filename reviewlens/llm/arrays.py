"""Arrow text columns as numpy arrays: bounded pieces, words, word hashes.

A text column arrives in a task as one byte buffer with offsets. The functions here cut it into pieces of
bounded size and find words without a Python loop over words or characters.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A-Z to a-z, every other byte to itself.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)
_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def pieces(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of a piece hold ``limit`` bytes at most, or are a single row."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        upto, at = np.cumsum(size, dtype=np.int64), 0
        while at < batch.num_rows:
            before = upto[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(upto, before + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins, with the end appended; null is empty."""
    column = pc.fill_null(column, "") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def spans(member: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of ``member`` that stay inside a row: begin, end, and the number of runs per row."""
    if not len(member):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    edges = offsets[1:-1]
    before = np.concatenate([[False], member[:-1]])
    before[edges[edges < len(member)]] = False
    after = np.concatenate([member[1:], [False]])
    after[edges[edges > 0] - 1] = False
    begin, end = np.flatnonzero(member & ~before), np.flatnonzero(member & ~after) + 1
    return begin, end, np.diff(np.searchsorted(begin, offsets))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose output bits all depend on the input."""
    x = x * _K1
    x ^= x >> np.uint64(32)
    x *= _K2
    x ^= x >> np.uint64(29)
    return x


def hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, the same on every machine."""
    lanes = np.ndarray(len(data) + 1, "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,))
    size = end - begin
    out = mix(mix(size.astype(np.uint64)) ^ (lanes[begin] & _MASK[np.minimum(size, 8)]))
    rest, k = np.flatnonzero(size > 8), 8
    while rest.size:
        lane = lanes[begin[rest] + k] & _MASK[np.minimum(size[rest] - k, 8)]
        out[rest] = mix(out[rest] ^ lane)
        k += 8
        rest = rest[size[rest] > k]
    return out


def ragged(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For lists of these sizes laid end to end: the list of each element and its place in that list."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
