"""Vectorised work on the UTF-8 bytes of many texts at a time, for use inside Spark tasks.

A *piece* is a run of rows whose texts lie one after the other in a byte array, with
the offsets of the rows. Pieces are about a megabyte, or one text where that is
longer, so the arrays made on the way stay small whatever a batch holds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

#: True for the bytes that part words: the space and 0x09 to 0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True

#: Lower case for A-Z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PER_BYTE = 0xD6E8FEB86659FD93
_powers: dict[int, np.ndarray] = {}


def text_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[ends[0] : ends[-1]], ends - ends[0]


def pieces(
    data: np.ndarray, offsets: np.ndarray, limit: int = PIECE_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of each piece."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1
        high = min(max(high, low + 1), n)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~SEPARATOR[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    opens[edges] |= inside[edges]
    closes[edges - 1] |= inside[edges - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, np.searchsorted(offsets, starts, "right") - 1


def per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of a value per byte over each row."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = max(n, PIECE_BYTES + 64)
        table = np.full(size, np.uint64(base), np.uint64)
        table[0] = 1
        np.multiply.accumulate(table, out=table)
        _powers[base] = table
    return table


def hash_numbers() -> tuple[bytes, str, str]:
    """What a fingerprint without salt is made of: codes of bytes, factor from byte to byte, term for each byte."""
    return _CODES.astype("<u8").tobytes(), str(_INVERSE), str(_PER_BYTE)


class SpanHash:
    """64-bit fingerprints of any byte spans of a piece, a few operations for each span.

    The fingerprint is a polynomial in the bytes; prefix sums of its terms give every
    span at once. ``salt`` gives another polynomial, for a second, independent one.
    """

    def __init__(self, data: np.ndarray, salt: int = 0):
        base = (_BASE * (2 * salt + 1) + 4 * salt) % (1 << 64) | 1
        inverse = pow(base, -1, 1 << 64)
        self._up = _power_table(base, len(data) + 1)
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_CODES[data] * _power_table(inverse, len(data) + 1)[: len(data)], out=self._sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = (ends - starts).astype(np.uint64) * np.uint64(_PER_BYTE)
        return mix((self._sums[ends] - self._sums[starts]) * self._up[starts] + length)

    def windows(self, size: int) -> np.ndarray:
        """The fingerprint of each span of ``size`` bytes, by its start."""
        n = max(0, len(self._sums) - size)
        length = np.uint64(size * _PER_BYTE % (1 << 64))
        return mix((self._sums[size:] - self._sums[:n]) * self._up[:n] + length)
