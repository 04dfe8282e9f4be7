"""Splitting of texts before the merges of byte-level BPE, vectorised over a batch.

The same pieces as the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

gives: runs of one character class, where one blank before a run belongs to it,
longer white space leaves its last character to what follows, and a lone
apostrophe takes an English ending with it.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER = range(4)
_WHITE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of each code point."""
    of = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[_WHITE] = SPACE
    return out


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) byte positions of the pieces of UTF-8 texts that lie end to end;
    ``offsets`` are where the texts begin, and the end. No piece crosses texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    table = classes()
    high = data >= 0x80
    if high.any():
        at = np.flatnonzero((data & 0xC0) != 0x80)  # first byte of each character
        b = data[at].astype(np.int32)
        cp = b.copy()
        wide = np.flatnonzero(b >= 0xC0)
        p, lead = at[wide], b[wide]
        more = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        v = lead & np.where(more == 1, 0x1F, np.where(more == 2, 0x0F, 0x07))
        for k in range(1, 4):
            on = more >= k
            v[on] = v[on] << 6 | data[p[on] + k] & 0x3F
        cp[wide] = v
    else:
        at, cp = np.arange(n), data.astype(np.int32)
    kind = table[cp]
    m = len(at)
    begin = np.zeros(m + 1, bool)  # texts begin here
    begin[np.searchsorted(at, offsets)] = True
    begin[m] = True
    start = begin.copy()
    start[1:m] |= kind[1:] != kind[:-1]
    # white space that something follows in its text: its last character stands alone, or joins if it is a blank
    last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~begin[1:m])
    blank = cp[last] == 32
    start[last] = True
    start[last[blank] + 1] = False
    # endings after an apostrophe that no blank joined
    q = np.flatnonzero((cp == 39) & start[:m])
    q = q[(q + 1 < m)]
    q = q[~begin[q + 1]]
    c1 = cp[q + 1]
    one = np.isin(c1, [ord(c) for c in "stmd"])
    c2 = np.where(q + 2 < m, cp[np.minimum(q + 2, m - 1)], 0)
    c2[begin[np.minimum(q + 2, m)]] = 0
    two = ((c1 == ord("r")) | (c1 == ord("v"))) & (c2 == ord("e")) | (c1 == ord("l")) & (c2 == ord("l"))
    for hit, length in ((one, 2), (two, 3)):
        start[q[hit] + 1] = False
        start[q[hit] + length] = True
    cut = at[np.flatnonzero(start[:m])]
    return cut.astype(np.int64), np.append(cut[1:], n).astype(np.int64)
