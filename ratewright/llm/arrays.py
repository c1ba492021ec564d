"""NumPy helpers that work on Arrow text columns inside Spark tasks.

A *word* is a maximal run of bytes other than space and 0x09-0x0D; these are all ASCII, so words can be
found in UTF-8 bytes.  Nothing here decodes text or loops over words in Python.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_VALUE = np.random.Generator(np.random.PCG64(20240229)).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_WINDOW_BASES = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_U64 = (1 << 64) - 1


class _Powers:
    """Powers of an odd base and of its inverse modulo 2**64, extended on demand and shared by a worker's tasks."""

    def __init__(self, base: int):
        self.base, self.inverse, self.n = base, pow(base, -1, 1 << 64), 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.n:
            size = max(n, 1 << 16)
            self.up, self.down = (np.cumprod(np.r_[np.uint64(1), np.full(size, b, np.uint64)]) for b in (self.base, self.inverse))
            self.n = size
        return self.up, self.down


POWERS = _Powers(_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), so that low and high bits depend on every bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; nulls become empty texts."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offs[0] : offs[-1]], offs - offs[0]


def row_chunks(offsets: np.ndarray, limit: int = 1 << 21, rows: int = 50_000) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges of at most `limit` bytes (a longer row stands alone) and at most `rows` rows."""
    at, n = 0, len(offsets) - 1
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n, at + rows)
        yield at, end
        at = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which `span_hash` takes the hash of any span of `data`."""
    up, _ = POWERS.get(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, down = POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end) of every word and, per row, the number of the row's first word (n rows + 1 entries)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    sep = _SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    before = np.r_[True, sep[:-1]] | edge[:-1]
    after = np.r_[sep[1:], True] | edge[1:]
    start = np.flatnonzero(~sep & before)
    end = np.flatnonzero(~sep & after) + 1
    return start, end, np.searchsorted(start, offsets)


def window_hash(values: np.ndarray, length: int, lane: int = 0) -> np.ndarray:
    """Hash of every `length` consecutive values (crossing rows too: mask those out with `inside`)."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base, out = np.uint64(_WINDOW_BASES[lane]), np.zeros(n, np.uint64)
    for j in range(length):
        out *= base
        out += values[j : n + j]
    return mix(out)


def inside(first: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the windows of `length` that lie in one row, and their rows."""
    counts = np.maximum(np.diff(first) - length + 1, 0)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[:-1][row]
    return at, row


def min_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable node of 0..n-1 over the links a-b (hooking with pointer jumping)."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped
    return label


def releasing(run):
    """A mapInArrow function that hands freed memory back when its partition ends: a worker is kept for the tasks of later stages."""

    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # another C library
                pass

    return wrapped


def text_slices(batch: pa.RecordBatch, column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about `limit` bytes of text, so that few texts are Python objects at a time."""
    _, offs = text_column(batch.column(column))
    for a, b in row_chunks(offs, limit):
        yield batch.slice(a, b - a)
