"""Vectorised work on the byte buffers of Arrow text columns."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes 0x20 and 0x09-0x0D separate words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


def keys(n: int, seed: int) -> np.ndarray:
    """n pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=U64) + U64(seed)) * U64(0x9E3779B97F4A7C15) + U64(1))


_BYTE_KEYS = keys(256, 11)
_POSITION_KEYS = keys(1 << 10, 7777)


def _position_keys(n: int) -> np.ndarray:
    global _POSITION_KEYS
    if n > len(_POSITION_KEYS):
        _POSITION_KEYS = keys(1 << int(n - 1).bit_length(), 7777)
    return _POSITION_KEYS


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and its row offsets (rows + 1); null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def pieces(offsets: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` bytes, or of one row that is longer."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, rows)
        first = last


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of each word, and the number of words in each row; `between` marks the bytes that separate."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    space = between[data]
    fresh = np.empty(len(data), bool)
    fresh[0] = True
    fresh[1:] = space[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    fresh[inner] = True
    starts = np.flatnonzero(fresh & ~space)
    last = np.empty(len(data), bool)
    last[-1] = True
    last[:-1] = space[1:]
    last[inner[inner > 0] - 1] = True
    ends = np.flatnonzero(last & ~space) + 1
    count = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, count


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 17) -> np.ndarray:
    """A 64-bit hash of each word: a multilinear sum over its bytes, then mixed with its length. Memory follows the bytes
    of `block` words."""
    out = np.zeros(len(starts), U64)
    for a in range(0, len(starts), block):
        begin = starts[a : a + block]
        length = ends[a : a + block] - begin
        first = np.cumsum(length) - length
        within = np.arange(int(length.sum())) - np.repeat(first, length)
        at = np.repeat(begin, length) + within
        with np.errstate(over="ignore"):
            part = _BYTE_KEYS[data[at]] * _position_keys(int(length.max()))[within]
            out[a : a + block] = mix(np.add.reduceat(part, first) + length.astype(U64) * U64(0xD6E8FEB86659FD93))
    return out


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run`, and after a task's last batch its freed memory goes back to the system: workers wait for further tasks beside the JVM."""

    def out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):  # another C library
            pass

    return out
