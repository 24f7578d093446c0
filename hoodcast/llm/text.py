"""Vectorised word handling shared by the operators of this subpackage.

Texts travel to Python as Arrow binary columns; a batch's bytes are then one
numpy buffer. Words are maximal runs of bytes other than space, tab, newline,
vertical tab, form feed and carriage return. Hashes are 64-bit and depend only
on the bytes, never on the batch, task or process.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once inside a task (one longer text is handled alone).
SLICE_BYTES = 4 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_S29, _S32 = np.uint64(29), np.uint64(32)
#: keep the first n bytes of a little-endian 8-byte load
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """In-place 64-bit finaliser; returns its argument."""
    h ^= h >> _S32
    h *= _M2
    h ^= h >> _S29
    h *= _M3
    h ^= h >> _S32
    return h


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the ordered pair (a, b), element by element."""
    return mix(a * _M1 + (b ^ (b >> _S29)) + _M3)


@dataclass
class Slice:
    """Some consecutive texts of a batch: rows ``lo`` to ``hi``."""
    lo: int
    hi: int
    data: np.ndarray      # uint8
    offsets: np.ndarray   # int64, one more than there are texts, from 0

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def slices(column: pa.Array, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """Cut a binary column into runs of rows of at most ``max_bytes`` (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"")
    n = len(column)
    if not n:
        return
    big = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, off_buf, data_buf = column.buffers()
    offsets = np.frombuffer(off_buf, np.int64 if big else np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + max_bytes, "right")) - 1)
        hi = min(hi, n)
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


@dataclass
class Words:
    starts: np.ndarray    # byte offsets into the slice
    ends: np.ndarray
    first: np.ndarray     # first[i]:first[i + 1] are the words of text i

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Word boundaries of consecutive texts; no word spans two texts."""
    n = len(data)
    inside = np.zeros(n + 1, bool)
    np.logical_not(SPACE[data], out=inside[:n])
    before = np.zeros(n + 1, bool)
    before[1:] = inside[:n]
    before[offsets] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(n + 1, bool)
    after[:n] = inside[1:]
    cut = offsets[offsets > 0] - 1
    after[cut] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(starts, ends, np.searchsorted(starts, offsets))


def word_hashes(data: np.ndarray, w: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of every word's bytes, eight bytes a step."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[:len(data)] = data
    loads = np.ndarray((len(data) + 1,), np.dtype("<u8"), padded, 0, (1,))
    at, left = w.starts, w.ends - w.starts
    h = (left.astype(np.uint64) + np.uint64(seed)) * _M1 + _M2
    live = None
    while len(at):
        chunk = loads[at] & _KEEP[np.minimum(left, 8)]
        if live is None:
            h = combine(h, chunk)
        else:
            h[live] = combine(h[live], chunk)
        more = left > 8
        if not more.any():
            break
        live = np.flatnonzero(more) if live is None else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


def window_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive entries (runs over text borders included),
    by doubling: O(log n) passes."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    powers, width = {1: h}, 1
    while width * 2 <= n:
        p = powers[width]
        powers[width * 2] = combine(p[:len(p) - width], p[width:])
        width *= 2
    out, done = powers[width], width
    while done < n:
        width = 1 << ((n - done).bit_length() - 1)
        tail = powers[width][done:]
        m = min(len(out), len(tail))
        out = combine(out[:m], tail[:m])
        done += width
    return out[:len(h) - n + 1]


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """Indices of the words at which a window of ``n`` words of one text begins."""
    total = int(first[-1])
    ok = np.zeros(total + 1, np.int32)
    counts = np.diff(first) - n + 1
    has = counts > 0
    np.add.at(ok, first[:-1][has], 1)
    np.add.at(ok, first[:-1][has] + counts[has], -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z; every other byte stays."""
    out = data.copy()
    out[(data >= 65) & (data <= 90)] += 32
    return out
