"""Vectorised word and shingle hashing over Arrow string batches.

Everything here works on the UTF-8 bytes of a whole Arrow batch at once: words are found with a
byte table, every word gets a 64-bit hash from one prefix sum, and shingles are combined from word
hashes. White space and letter case are ASCII only, so byte work equals code point work.

Hashes are 64 bit: two different words or shingles share one with probability about 2**-64 a pair.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Space and the controls 0x09-0x0D, the class [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Everything that is neither an ASCII letter or digit nor part of a longer UTF-8 sequence.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(ord("0"), ord("9") + 1), *range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = False

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_EMPTY = np.uint64(0x2545F4914F6CDD1D)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its n + 1 offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8) if offsets else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


class Words:
    """Words of each text of a batch: starts, ends, 64-bit hashes, and first[i]:first[i+1] for text i."""

    def __init__(self, column: pa.Array, lower: bool = True, breaks: np.ndarray = SPACE):
        buf, off = utf8(column)
        gap = breaks[buf]
        edge = np.empty(len(buf) + 1, bool)  # a text's first byte starts a word even after a letter
        edge[:-1] = gap
        edge[off[1:]] = True
        start = ~gap
        if len(buf):
            before = np.concatenate(([True], gap[:-1]))
            before[off[:-1][off[:-1] < len(buf)]] = True
            start &= before
        self.starts = np.flatnonzero(start)
        ends = ~gap
        ends &= edge[1:]
        self.ends = np.flatnonzero(ends) + 1
        self.offsets, self.bytes = off, buf
        self.first = np.searchsorted(self.starts, off).astype(np.int64)
        self.hashes = _span_hashes(LOWER[buf] if lower else buf, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


_POWERS = {}


def _powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * _BLOCK), base, np.uint64)
        have[0] = 1
        have = _POWERS[base] = np.multiply.accumulate(have)
    return have[:n]


#: Spans are hashed relative to the start of blocks of so many bytes: tables stay small and in cache.
_BLOCK = 1 << 15
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def _span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span buf[start:end] (sorted, not overlapping), independent of its place."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = int(np.searchsorted(starts, base + _BLOCK))
        stop = int(ends[to - 1])
        n = stop - base
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buf[base:stop]] * _powers(n, _BASE), out=prefix[1:])
        s, e = starts[at:to] - base, ends[at:to] - base
        out[at:to] = (prefix[e] - prefix[s]) * _powers(n, _INVERSE)[s]
        at = to
    return mix(out ^ ((ends - starts).astype(np.uint64) * _M2))


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word windows of every text, in order, and the n + 1 bounds of the texts.

    A text of 1 to k - 1 words gives one shingle, its whole sequence; one without words none.
    """
    h, counts = words.hashes, words.counts()
    n = np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))
    bounds = np.concatenate(([0], np.cumsum(n))).astype(np.int64)
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    where = np.arange(bounds[-1]) + np.repeat(words.first[:-1] - bounds[:-1], n)
    acc = np.full(len(where), _EMPTY, np.uint64)
    length = np.minimum(np.repeat(counts, n), k)
    for j in range(k):
        some = length > j
        if some.all():
            acc = acc * _BASE + mix(h[where + j] + np.uint64(j))
        else:
            acc[some] = acc[some] * _BASE + mix(h[where[some] + j] + np.uint64(j))
    return mix(acc ^ length.astype(np.uint64)), bounds


def owners(bounds: np.ndarray) -> np.ndarray:
    """The text of each element, from the texts' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def distinct(values: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct values (the first of each stays in its place), with new bounds."""
    own = owners(bounds)
    order = np.argsort(values)
    v = values[order]
    same = np.zeros(len(v) + 1, bool)
    same[1:-1] = v[1:] == v[:-1]
    part = order[same[1:] | same[:-1]]  # values that occur twice or more in the batch
    part = part[np.lexsort((part, own[part], values[part]))]
    again = (values[part[1:]] == values[part[:-1]]) & (own[part[1:]] == own[part[:-1]])
    keep = np.ones(len(v), bool)
    keep[part[1:][again]] = False
    return values[keep], np.concatenate(([0], np.cumsum(keep)))[bounds].astype(np.int64)
