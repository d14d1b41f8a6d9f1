"""Vectorised text helpers for Arrow tasks: byte tables, word spans and 64-bit hashes.

Everything here works on one bounded slice of an Arrow batch at a time, so a task's memory does not
depend on how many rows Spark sends in a batch.  A single text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; each costs about 60 bytes of working memory.
SLICE_BYTES = 1_000_000

_MULT = np.uint64(0x9E3779B97F4A7C15)
_PRIME, _LOW30, _LOW31 = np.uint64(2**61 - 1), np.uint64(2**30 - 1), np.uint64(2**31 - 1)
_BASE61 = 0x0C3B1F7A95E2D483
_INVERSE61 = pow(_BASE61, -1, 2**61 - 1)
#: Bytes that are summed at once: their sums of products stay far below 2**62, and they fit a cache.
_RUN = 1 << 15
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: spreads every input bit over the whole word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def powers(base: int, n: int) -> np.ndarray:
    """base**i mod 2**64 for i < n at least."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        got = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        got[0] = 1
        np.multiply.accumulate(got, out=got)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = got
    return got


def table(separators: bytes) -> np.ndarray:
    """True for the bytes that belong to words."""
    out = np.ones(256, bool)
    out[list(separators)] = False
    return out


#: Words are runs of anything but blanks.
BLANKS = table(bytes([0x20, *range(0x09, 0x0E)]))
#: Words are runs of ASCII letters and digits, and of anything beyond ASCII.
ALNUM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows that hold about `limit` bytes; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, min(n, int(np.searchsorted(off, off[row] + limit, "right")) - 1))
        yield row, data[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a * b modulo the prime 2**61 - 1, for factors below it, in blocks that fit a cache."""
    out = np.empty(len(a), np.uint64)
    for k in range(0, len(a), _RUN):
        x, y = a[k : k + _RUN], b[k : k + _RUN]
        x1, x0, y1, y0 = x >> np.uint64(31), x & _LOW31, y >> np.uint64(31), y & _LOW31
        mid = x1 * y0
        mid += x0 * y1
        x1 *= y1
        x1 <<= np.uint64(1)
        x0 *= y0
        x1 += mid >> np.uint64(30)
        mid &= _LOW30
        mid <<= np.uint64(31)
        x1 += mid
        x1 += x0
        out[k : k + len(x)] = residue(x1)
    return out


def residue(x: np.ndarray) -> np.ndarray:
    """x modulo 2**61 - 1."""
    x = (x & _PRIME) + (x >> np.uint64(61))
    return np.minimum(x, x - _PRIME)  # wraps around below the prime


def prime_powers(base: int, n: int) -> np.ndarray:
    """base**i modulo 2**61 - 1 for i < n at least."""
    key = -base
    got = _powers.get(key)
    if got is None or len(got) < n:
        got, size = np.ones(1, np.uint64), max(n, SLICE_BYTES + 1)
        while len(got) < size:
            step = np.uint64(pow(base, len(got), int(_PRIME)))
            got = np.concatenate([got, times(got[: size - len(got)], np.full(min(len(got), size - len(got)), step))])
        if n <= 4 * SLICE_BYTES:
            _powers[key] = got
    return got


class Prefix:
    """Polynomial prefix sums of one slice modulo 2**61 - 1: the hash of any span in constant time.

    Two spans of n bytes that differ have one hash for n of the 2**61 bases at most.
    """

    def __init__(self, data: np.ndarray):
        power = prime_powers(_BASE61, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        for a in range(0, len(data), _RUN):
            value = data[a : a + _RUN].astype(np.uint64)
            value += np.uint64(1)
            here = power[a : a + len(value)]
            high, low = np.cumsum(value * (here >> np.uint64(31))), np.cumsum(value * (here & _LOW31))
            low += high >> np.uint64(30)
            high &= _LOW30
            high <<= np.uint64(31)
            high += low
            high = residue(high)
            self.sums[a + 1 : a + 1 + len(value)] = residue(high + self.sums[a]) if a else high

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """64-bit hashes of the spans; equal bytes give equal hashes wherever they stand."""
        back = prime_powers(_INVERSE61, len(self.sums))
        apart = self.sums[end] + _PRIME - self.sums[start]
        return mix(times(residue(apart), back[start]) + (end - start).astype(np.uint64) * _MULT)


def spans(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of all words of a slice; words never cross texts; first[i] is text i's first word."""
    word = np.zeros(len(data) + 2, bool)
    word[1:-1] = inside[data]
    begin = word[1:-1] & ~word[:-2]
    close = word[1:-1] & ~word[2:]
    cut = off[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begin[cut] = word[cut + 1]
    close[cut - 1] = word[cut]
    start, end = np.flatnonzero(begin), np.flatnonzero(close) + 1
    return start, end, np.searchsorted(start, off)


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of the words of a slice, A-Z lower-cased."""
    start, end, first = spans(data, off, inside)
    return Prefix(LOWER[data]).spans(start, end), first


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices starts[i], starts[i] + 1, ... for lengths[i] steps, one row after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths, lengths) + np.repeat(starts, lengths)


def shingles(data: np.ndarray, off: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first) of the distinct word n-grams of each text, sorted within a text.

    A text of fewer words, but not none, has its whole sequence as the one shingle.
    """
    word, first = words(data, off, BLANKS)
    count = np.diff(first)
    width = np.minimum(count, n)
    sums = np.zeros(len(word) + 1, np.uint64)
    np.cumsum(word * powers(_BASE, len(word))[: len(word)], out=sums[1:])
    per = np.where(count > 0, count - width + 1, 0)
    at = ragged(first[:-1], per)
    wide = np.repeat(width, per)
    h = mix((sums[at + wide] - sums[at]) * powers(_INVERSE, len(sums))[at] + wide.astype(np.uint64) * _MULT)
    doc = np.repeat(np.arange(len(per)), per)
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    return h[keep], np.searchsorted(doc[keep], np.arange(len(per) + 1))


def ipc(batch: pa.RecordBatch) -> bytes:
    """A small batch as one binary value, so that it travels as one row."""
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()
