"""Word hashes of Arrow text columns, computed on whole batches with numpy.

Words are the maximal runs of bytes other than space and 0x09-0x0D. The
separators are ASCII, so cutting UTF-8 bytes gives the same words as cutting
characters. A batch of texts is handled as one byte array; nothing here makes
a Python object per word.

Hashes have 64 bits. Two different words (or word sequences) of a batch of
``n`` collide with a probability near ``n**2 / 2**65``; callers that need
certainty compare the words themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: One random 64-bit value per byte, and an odd multiplier with its inverse modulo 2**64.
_BYTE = np.random.Generator(np.random.PCG64(20240501)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below n."""
    out = np.full(max(n, 1), base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)[:n]


class _Powers:
    """Powers of the byte multiplier and of its inverse, grown on demand, once per process."""

    up = np.zeros(0, dtype=np.uint64)
    down = np.zeros(0, dtype=np.uint64)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 20)
            cls.up, cls.down = powers(_BASE, size), powers(_BASE_INVERSE, size)
        return cls.up[:n], cls.down[:n]


@dataclass
class Words:
    """The words of a batch of texts, text after text.

    ``first[i]:first[i + 1]`` are the words of text ``i``; ``begin`` and
    ``end`` are their byte positions in ``data``; ``hash`` their hashes.
    """

    data: np.ndarray
    first: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    hash: np.ndarray

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def joined(self, lo: int, hi: int) -> bytes:
        """Words lo to hi (of the batch) joined by one space."""
        return joined(self.data, self.begin[lo:hi], self.end[lo:hi])


def joined(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> bytes:
    """Words at the given places, in order, joined by one space."""
    if len(begin) == 0:
        return b""
    length = end - begin
    raw = data[begin[0] : end[-1]]
    if len(begin) > 1 and int((end[-1] - begin[0])) == int(length.sum()) + len(begin) - 1:
        # nothing is left out and one separator stands between words
        out = raw.copy()
        out[end[:-1] - begin[0]] = 0x20
        return out.tobytes()
    total = int(length.sum()) + len(begin) - 1
    out = np.full(total, 0x20, dtype=np.uint8)
    to = np.cumsum(length + 1) - (length + 1)
    where = np.arange(int(length.sum()), dtype=np.int64)
    shift = np.repeat(np.cumsum(length) - length, length)
    where -= shift
    out[where + np.repeat(to, length)] = data[where + np.repeat(begin, length)]
    return out.tobytes()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the places where each text starts; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or offsets is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(n + 1, dtype=np.int64)
    starts = np.frombuffer(offsets, dtype=np.int64, count=n + 1 + column.offset)[column.offset :]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def words_of(column: pa.Array, lower: bool = False) -> Words:
    """The words of every text of a column, A-Z lower-cased if asked."""
    data, starts = text_bytes(column)
    if lower:
        data = _LOWER[data]
    n = len(data)
    # a separator before and after, and between texts that touch
    inside = ~_SPACE[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = starts[:-1][starts[:-1] < n]
    opens[edges] = inside[edges]
    begin = np.flatnonzero(opens)
    # a word ends where the next byte is a separator, or where a text ends
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tails = starts[1:][starts[1:] > 0] - 1
    last[tails] = inside[tails]
    end = np.flatnonzero(last) + 1
    first = np.searchsorted(begin, starts, side="left")
    return Words(data, first.astype(np.int64), begin, end, _word_hashes(data, begin, end))


def _word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    if len(begin) == 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.empty(len(begin), dtype=np.uint64)
    # blocks of words keep the temporary arrays, eight bytes per byte, small
    block = 1 << 21
    lo = 0
    while lo < len(begin):
        hi = max(int(np.searchsorted(end, begin[lo] + block, side="right")), lo + 1)
        origin, stop = int(begin[lo]), int(end[hi - 1])
        up, down = _Powers.upto(stop - origin)
        sums = np.zeros(stop - origin + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[origin:stop]] * up, out=sums[1:], dtype=np.uint64)
        b, e = begin[lo:hi] - origin, end[lo:hi] - origin
        out[lo:hi] = (sums[e] - sums[b]) * down[b] + (e - b).astype(np.uint64)
        lo = hi
    return mix(out)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes, whatever text they belong to."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for i, factor in enumerate(powers(0xD1B54A32D192ED03, k + 1)[1:]):
        out += hashes[i : i + n] * factor
    return mix(out)


def rolling_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """As ``gram_hashes`` for long windows: one pass, however long the window is."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    base = 0xD1B54A32D192ED03
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(base, len(hashes)), out=sums[1:], dtype=np.uint64)
    return mix((sums[k:] - sums[:-k]) * powers(pow(base, -1, 1 << 64), n))


def text_numbers(first: np.ndarray) -> np.ndarray:
    """For every word of the batch, the number of its text."""
    return np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as signed values, as Spark's long has them."""
    return np.ascontiguousarray(x).view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.uint64)
