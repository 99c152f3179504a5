"""Vectorised byte work inside Arrow batches: words, range hashes and per-document sums.

Everything here runs inside a Spark task on a slice of a batch (about `SLICE` bytes, or one
document if that is longer), so memory is bounded by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SLICE = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (xor-shift and multiply)."""
    x = np.asarray(x, U64)
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def constants(seed: int, n: int) -> np.ndarray:
    """n odd 64-bit numbers that depend on the seed alone."""
    return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LANES = constants(77, 16)
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], U64)
#: Ranges longer than this are hashed one by one with xxh3, shorter ones eight bytes at a time for all ranges together.
LONG = 512


class Hasher:
    """64-bit hashes of any byte ranges of one buffer: eight bytes are mixed in at a time, after the length."""

    def __init__(self, buf: np.ndarray):
        self.buf = buf
        padded = np.zeros(len(buf) + 16, np.uint8)
        padded[: len(buf)] = buf
        self.load = np.ndarray((len(buf) + 9,), np.dtype("<u8"), padded, strides=(1,))  # eight bytes from every place on

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        start = np.asarray(start, np.int64)
        size = np.asarray(end, np.int64) - start
        h = mix(self.load[start] & _MASK[np.minimum(size, 8)]) + size.astype(U64) * _LANES[0]
        at = np.flatnonzero((size > 8) & (size <= LONG))
        done = 8
        while len(at):
            h[at] = mix(h[at] ^ mix(self.load[start[at] + done] & _MASK[np.minimum(size[at] - done, 8)])) + _LANES[1]
            done += 8
            at = at[size[at] > done]
        for i in np.flatnonzero(size > LONG):
            h[i] = xxhash.xxh3_64_intdigest(self.buf[start[i] : start[i] + size[i]].data)
        return mix(h)

    def every(self, size: int) -> np.ndarray:
        """Hashes of the ranges of `size` bytes (8 at least) from every place on. Weaker than those of single ranges:
        they choose and find candidates, which are compared by bytes."""
        n = len(self.buf) - size + 1
        if n <= 0:
            return np.zeros(0, U64)
        v = np.ascontiguousarray(self.load)
        v ^= v >> U64(29)
        total = v[:n] * _LANES[2]
        for k, at in enumerate([*range(8, size - 8, 8), size - 8]):
            total += v[at : at + n] * _LANES[3 + k % 13]
        return mix(total)


def same(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the ranges of a buffer from a and from b on hold the same bytes, compared eight at a time."""
    load = Hasher(buf).load
    out, at, done = np.ones(len(a), bool), np.flatnonzero(size > 0), 0
    while len(at):
        if len(at) < 4 and done >= LONG:  # the last few long ones
            for i in at:
                out[i] = buf[a[i] : a[i] + size[i]].tobytes() == buf[b[i] : b[i] + size[i]].tobytes()
            break
        mask = _MASK[np.minimum(size[at] - done, 8)]
        out[at] = equal = (load[a[at] + done] & mask) == (load[b[at] + done] & mask)
        done += 8
        at = at[equal & (size[at] > done)]
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    offs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf, offs


def slices(column: pa.Array, limit: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows with about `limit` bytes."""
    if not len(column):
        return
    buf, offs = text_buffers(column)
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = int(np.searchsorted(offs, offs[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n, lo + 60_000)
        yield lo, hi, buf[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]
        lo = hi


def words(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of maximal runs of bytes other than ASCII white space, none across rows,
    and for each row the index of its first word (one more entry at the end)."""
    n = len(buf)
    solid = ~SPACE[buf]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    gap = np.ones(n + 1, bool)  # gap[i]: byte i-1 and byte i do not continue a word
    gap[1:n] = ~(solid[:-1] & solid[1:]) | cut[1:n]
    s = np.flatnonzero(solid & gap[:n])
    e = np.flatnonzero(solid & gap[1:]) + 1
    return s, e, np.searchsorted(s, offs)


def per_row(mask: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """How many true entries of a mask over bytes (or words) each row has."""
    c = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=c[1:])
    return c[offs[1:]] - c[offs[:-1]]


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive entries of h (len(h) - k + 1 of them)."""
    if len(h) < k:
        return np.zeros(0, U64)
    total = np.zeros(len(h) - k + 1, U64)
    for j, c in enumerate(constants(5, k)):
        total += h[j : j + len(total)] * c
    return mix(total)
