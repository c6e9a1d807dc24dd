"""Words `[^\\x20\\x09-\\x0D]+` of many texts at once, on the UTF-8 bytes that Arrow hands over.

All separators are ASCII, so byte positions split UTF-8 safely. Hashes are polynomial prefix sums over a
random table of byte values, mixed per word; two words or windows get equal 64-bit values by chance only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
IS_SEPARATOR = np.zeros(256, dtype=bool)
IS_SEPARATOR[list(SEPARATORS)] = True
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INVERSE = pow(BASE, -1, 1 << 64)
CHUNK_BYTES = 1 << 20
COUNT_SQL = r"coalesce(regexp_count({0}, '[^\\x20\\x09-\\x0D]+'), 0)"


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with at most `most` bytes, or a single longer row. Null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if len(column) == 0:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1, row + 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word; no word crosses a row."""
    inside = ~IS_SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    at = offsets[:-1][offsets[:-1] < len(data)]
    first[at] = inside[at]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    at = offsets[1:][offsets[1:] > 0] - 1
    last[at] = inside[at]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """1, base, base^2 ... modulo 2^64, at least n of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 7) -> np.ndarray:
    """A 64-bit value of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.cumsum(_table(seed)[data] * powers(BASE, len(data)), dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    value = (total[ends - 1] - before) * powers(BASE_INVERSE, len(data))[starts]
    return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@cache
def _factors(k: int, seed: int) -> np.ndarray:
    return np.random.default_rng(1000 + seed).integers(1, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def window_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit value of each run of k words, by first word; rows are not heeded (see whole_windows)."""
    n = max(len(words) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j, factor in enumerate(_factors(k, seed)):
        out += words[j : j + n] * factor
    return mix(out)


def whole_windows(rows: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each start lie in one row."""
    n = max(len(rows) - k + 1, 0)
    return rows[:n] == rows[k - 1 : k - 1 + n]


def covered(n: int, starts: np.ndarray, k: int) -> np.ndarray:
    """Of n words, those in a window of k words that starts at one of `starts`."""
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + k, -1)
    return np.cumsum(steps[:n]) > 0
