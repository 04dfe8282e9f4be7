"""Binary Golay code [23, 12, 7] as a fuzzy hash of 23-bit words.

The keys of a word are the codewords within 4 bits of it: one for about an eighth
of all words, six for the others. Two words that differ in at most 2 bits always
share a key: the word between them lies within 3 bits of a codeword (the code is
perfect), which is then within 4 bits of both.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BITS = 23
#: x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
_GENERATOR = 0xC75
MOST = 6


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray]:
    """(patterns, counts) by syndrome: error patterns of weight up to 4 that lead
    from a word with that syndrome to a codeword."""
    one = np.zeros(BITS, np.int64)  # syndrome of each single bit
    for i in range(BITS):
        r = 1 << i
        for j in range(BITS - 1, 10, -1):
            if r >> j & 1:
                r ^= _GENERATOR << (j - 11)
        one[i] = r
    patterns = np.zeros((2048, MOST), np.int64)
    counts = np.zeros(2048, np.int64)

    def add(pattern: int, syndrome: int, start: int, left: int) -> None:
        patterns[syndrome, counts[syndrome]] = pattern
        counts[syndrome] += 1
        if left:
            for i in range(start, BITS):
                add(pattern | 1 << i, syndrome ^ int(one[i]), i + 1, left - 1)

    add(0, 0, 0, 4)
    return patterns, counts


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of each 23-bit word by the generator."""
    r = words.astype(np.int64, copy=True)
    for j in range(BITS - 1, 10, -1):
        r ^= np.where(r >> j & 1, _GENERATOR << (j - 11), 0)
    return r


def keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, index): the 12-bit indices of the codewords near each word. The code
    is systematic in its upper 12 bits, so these are the index."""
    patterns, counts = _tables()
    words = np.asarray(words, np.int64)
    s = syndrome(words)
    row = np.repeat(np.arange(len(words)), counts[s])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(counts[s]) - counts[s], counts[s])
    return row, (words[row] ^ patterns[s[row], nth]) >> 11
