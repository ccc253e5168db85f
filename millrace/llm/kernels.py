"""Array kernels over UTF-8 text, run on the executors by ``mapInArrow``.

Texts are worked on as bytes in chunks of about one MB (a longer text is a chunk
of its own), so memory follows the longest text and not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20
U = np.uint64
_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: Tables of large objects that an operator keeps in a worker process between its tasks.
KEPT: list[dict] = []


def let_go() -> None:
    """Free what other operators keep in this worker process; workers serve one stage after another."""
    for table in KEPT:
        table.clear()
    trim()


def trim() -> None:
    """Give freed memory back to the system; workers live on after a task."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc keeps freed pages otherwise
        trim(0)


class Powers:
    """Powers of the hash base and of its inverse, grown as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(0, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, CHUNK)
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                p = np.full(n, base, U)
                p[0] = 1
                setattr(self, name, np.cumprod(p))
        return self.up[:n], self.down[:n]


POWERS = Powers()


def text_chunks(column: pa.Array, size: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, last row, bytes, offsets)`` of runs of rows of about ``size`` bytes; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    row = 0
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        to = min(to, n)
        yield row, to, data[offsets[row] : offsets[to]], offsets[row : to + 1] - offsets[row]
        row = to
    pa.default_memory_pool().release_unused()  # workers live on after a task


def spans(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True in ``inside``; no run crosses a cut."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    at = cuts[(cuts > 0) & (cuts < n)]
    begins[at] |= inside[at]
    ends = np.zeros(n, bool)
    ends[:-1] = inside[:-1] & ~inside[1:]
    ends[-1] = inside[-1]
    ends[at - 1] |= inside[at - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    n = len(data)
    up, down = POWERS.upto(n + 1)
    run = np.zeros(n + 1, U)
    np.cumsum((data.astype(U) + U(1)) * up[:n], out=run[1:])
    return mix64((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(U))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the A-Z-lower-cased words between white space, and where each row's words start."""
    low = LOWER[data]
    starts, ends = spans(~SPACE[data], offsets[1:-1])
    return span_hashes(low, starts, ends), np.searchsorted(starts, offsets)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` word hashes."""
    if len(words) < size:
        return np.zeros(0, U)
    n = len(words) - size + 1
    out = np.full(n, U(size), U)
    for i in range(size):
        out = out * _BASE + words[i : i + n]
    return mix64(out)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingles; a shorter row is one shingle, a row without words none."""
    words, first = word_hashes(data, offsets)
    every = shingle_hashes(words, size)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= size:
            h = every[a : b - size + 1].copy()
            h.sort()
            yield h[np.append(True, h[1:] != h[:-1])]
        elif b > a:
            yield shingle_hashes(words[a:b], int(b - a))
        else:
            yield np.zeros(0, U)
