"""Words of many texts at once, as numpy arrays: where they start and end, and a 64-bit hash each.

A batch of texts is handled in runs of about ``RUN_BYTES``, so memory follows the run, or the longest
text where that is longer. The hash of a word depends on its bytes alone (fixed seed), so hashes made
in different tasks can be compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

RUN_BYTES = 512 << 10

_draw = np.random.default_rng(20240229)
_CODES = _draw.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_STEP = (1 << 16) - 1

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(text: bytes | bytearray | range | list[int], invert: bool = False) -> np.ndarray:
    """A table of 256 flags: True for the given bytes."""
    table = np.zeros(256, bool)
    table[np.frombuffer(bytes(text), np.uint8)] = True
    return ~table if invert else table


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column, and each row's first byte (one more at the end); null: empty."""
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if len(offsets) == 0 or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def runs(offsets: np.ndarray, size: int = RUN_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer row is a range of its own."""
    start, last = 0, len(offsets) - 1
    while start < last:
        stop = int(np.searchsorted(offsets, offsets[start] + size, side="right")) - 1
        stop = min(max(stop, start + 1), last)
        yield start, stop
        start = stop


def _powers(base: int, count: int) -> np.ndarray:
    """base**0 .. base**(count - 1) modulo 2**64."""
    small = np.full(min(count, _STEP), base, np.uint64)
    if count:
        small[0] = 1
    small = np.cumprod(small, dtype=np.uint64)
    if count <= _STEP:
        return small
    jump = np.full(-(-count // _STEP), pow(base, _STEP, 2**64), np.uint64)
    jump[0] = 1
    return (np.cumprod(jump, dtype=np.uint64)[:, None] * small[None, :]).reshape(-1)[:count]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0xCF1BBCDCB7A56463)
    return h ^ (h >> np.uint64(32))


_known = {_BASE: np.zeros(0, np.uint64), _BASE_INVERSE: np.zeros(0, np.uint64)}


def _known_powers(base: int, count: int) -> np.ndarray:
    """Powers of a base, kept for runs of the usual size."""
    if count > 2 * RUN_BYTES:
        return _powers(base, count)
    if len(_known[base]) < count:
        _known[base] = _powers(base, 2 * RUN_BYTES)
    return _known[base][:count]


class Prefix:
    """Hashes of any byte ranges of one buffer, from prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._inverse = _known_powers(_BASE_INVERSE, n + 1)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[data] * _known_powers(_BASE, n), out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))

    def rolling(self, size: int) -> np.ndarray:
        """A hash of each range of ``size`` bytes, not comparable with those of ``hashes``."""
        value = self._sums[size:] - self._sums[:-size]
        value *= self._inverse[: len(value)]
        value ^= value >> np.uint64(31)
        value *= np.uint64(0xD6E8FEB86659FD93)
        value ^= value >> np.uint64(32)
        return value


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal stretches of bytes in ``table``, and each row's first word (one more at the end)."""
    n = len(data)
    inside = table[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``width`` words inside each row, and each row's first window.

    A row of fewer words, but not none, is one window.
    """
    counts = np.diff(first)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    begin = np.concatenate(([0], np.cumsum(made)))
    row = np.repeat(np.arange(len(counts)), made)
    at = first[:-1][row] + np.arange(begin[-1]) - begin[:-1][row]
    out = np.full(begin[-1], 0x51ED270B, np.uint64)
    length = np.minimum(counts, width)[row]
    for k in range(width):
        used = length > k
        value = hashes[np.where(used, at + k, 0)] if len(hashes) else out
        out = np.where(used, mix(out ^ (value + np.uint64(k + 1))), out)
    return out, begin


def distinct_per_row(values: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct values in rising order, and each row's first one."""
    row = np.repeat(np.arange(len(begin) - 1), np.diff(begin))
    order = np.lexsort((values, row))
    values, row = values[order], row[order]
    keep = np.ones(len(values), bool)
    keep[1:] = (values[1:] != values[:-1]) | (row[1:] != row[:-1])
    return values[keep], np.searchsorted(row[keep], np.arange(len(begin)))
