"""Vectorised text kernels shared by the corpus operators.

Everything here works on whole Arrow batches with numpy: words are located and
hashed straight from the UTF-8 buffer, so no Python object is made per word.

Hashes are polynomial: ``sum(T[byte] * P**i)`` modulo 2**64 with odd ``P``.
Because ``P`` is invertible, one running sum over the batch yields the hash of
any slice as ``(S[end] - S[start]) * P**-start``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)
_MASK = (1 << 64) - 1


def _random_table(n: int, seed: int) -> np.ndarray:
    """splitmix64 stream: the same on every machine and numpy version."""
    x = (np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(_P)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser over a uint64 array."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_STRETCH = 1 << 18
BYTE_TABLE = _random_table(256, 7)
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P**i and P**-i for i in 0..n, grown on demand and kept."""
    global _POW, _INV
    if len(_POW) <= n:
        m = max(n + 1, 2 * len(_POW), 1 << 16)
        for name, base in (("_POW", _P), ("_INV", _P_INV)):
            a = np.full(m, base, np.uint64)
            a[0] = 1
            globals()[name] = np.multiply.accumulate(a)
    return _POW, _INV


def running(values: np.ndarray) -> np.ndarray:
    """Running polynomial sums of uint64 values, one longer than the input."""
    pw, _ = powers(len(values))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * pw[: len(values)], out=out[1:])
    return out


def slice_hash(run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for arrays of starts and ends."""
    _, inv = powers(len(run))
    return (run[end] - run[start]) * inv[start]


def utf8_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; a null counts as the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
        if isinstance(col, pa.ChunkedArray):
            col = col.chunk(0) if col.num_chunks else pa.array([], pa.string())
    if col.null_count:
        col = col.fill_null("")
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    buf = col.buffers()
    off = np.frombuffer(buf[1], np.int64)[col.offset : col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    lo, hi = int(off[0]), int(off[-1])
    data = np.frombuffer(buf[2], np.uint8)[lo:hi] if hi > lo else np.zeros(0, np.uint8)
    return data, off - lo


#: 1 for the ASCII bytes that separate words.
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True
#: Letters, digits, underscore and every byte of a multi-byte character.
WORDISH = np.zeros(256, bool)
WORDISH[[*range(48, 58), *range(65, 91), *range(97, 123), 95, *range(128, 256)]] = True


class Words:
    """Words of a batch: ``start``/``end`` byte positions, ``doc`` row numbers,
    ``first`` the index of each document's first word (one longer than rows)."""

    __slots__ = ("data", "offsets", "start", "end", "doc", "first", "_hash")

    def __init__(self, data: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray):
        self.data, self.offsets, self.start, self.end = data, offsets, start, end
        self.first = np.searchsorted(start, offsets, "left")
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self._hash = None

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            h = np.empty(len(self.start), np.uint64)
            lo = 0
            while lo < len(h):  # stretches of about _STRETCH bytes bound the running sums
                base = self.start[lo]
                hi = max(lo + 1, int(np.searchsorted(self.end, base + _STRETCH, "right")))
                run = running(BYTE_TABLE[self.data[base : self.end[hi - 1]]])
                h[lo:hi] = slice_hash(run, self.start[lo:hi] - base, self.end[lo:hi] - base)
                lo = hi
            self._hash = mix(h)
        return self._hash

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of the first word, hash) of each k-word window that lies within one document."""
        n = len(self.start) - k + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.arange(n)
        at = at[self.doc[:n] == self.doc[k - 1 :]]
        run = running(self.hash)
        return at, mix(slice_hash(run, at, at + k))


def split_words(col: pa.Array, punctuation: bool = False) -> Words:
    """Words separated by ASCII white space. With ``punctuation`` each run of
    word bytes and each run of other bytes is a word of its own."""
    data, off = utf8_buffer(col)
    n = len(data)
    kind = np.where(SPACE[data], 0, 1).astype(np.int8)
    if punctuation:
        kind[~SPACE[data] & ~WORDISH[data]] = 2
    new = np.zeros(n + 1, bool)
    if n:
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:n])
        new[off] = True
    cut = np.flatnonzero(new[:n])
    stop = np.append(cut[1:], n)
    keep = kind[cut] > 0 if n else np.zeros(0, bool)
    return Words(data, off, cut[keep].astype(np.int64), stop[keep].astype(np.int64))


def slices(batch: pa.RecordBatch, column: str | int, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of a batch whose texts together stay near ``limit`` bytes; a
    longer single text gets a range of its own, so memory follows the longest
    text rather than the number of rows."""
    col = batch.column(column)
    size = pa.compute.binary_length(col).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    total, lo = 0, 0
    for i, s in enumerate(size):
        if i > lo and total + s > limit:
            yield lo, i
            lo, total = i, 0
        total += int(s)
    if lo < len(size):
        yield lo, len(size)
