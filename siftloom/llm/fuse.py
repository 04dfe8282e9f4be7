"""Binary fuse filters (Graf and Lemire, 2022) over uint64 keys, with numpy.

A static filter of three probes and 8-bit fingerprints: no false negatives, a
false positive rate of 1/256, about nine bits a key.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from .textkernel import mix

_HEAD = struct.Struct("<QQII")


def _shape(n: int) -> tuple[int, int]:
    """(segment length, number of segments that a key's first probe may take)."""
    if n < 2:
        return 4, 1
    seg = 1 << min(18, max(2, int(math.log(n) / math.log(3.33) + 2.25)))
    factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
    return seg, max(1, math.ceil(n * factor / seg) - 2)


def _probes(keys: np.ndarray, seed: int, seg: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys + np.uint64(seed))
    # the high half picks the first segment by multiply and shift
    base = ((h >> np.uint64(32)) * np.uint64(count * seg)) >> np.uint64(32)
    mask = np.uint64(seg - 1)
    p0 = base
    p1 = (base + np.uint64(seg)) ^ ((h >> np.uint64(18)) & mask)
    p2 = (base + np.uint64(2 * seg)) ^ (h & mask)
    f = (mix(h) & np.uint64(255)).astype(np.uint8)
    return np.stack([p0, p1, p2]).astype(np.int64), f


def build(keys: np.ndarray) -> bytes:
    """Filter over the distinct keys as one byte string.

    Keys are peeled in rounds: a slot that one remaining key uses frees that key.
    Keys freed in one round can't use each other's slots, so each round is one
    vector step, and so is its assignment in reverse order.
    """
    keys = np.unique(np.asarray(keys, np.uint64))
    seg, count = _shape(len(keys))
    size = (count + 2) * seg
    for attempt in range(200):
        seed = (0x5851F42D4C957F2D * (attempt + 1)) & ((1 << 64) - 1)
        slots, f = _probes(keys, seed, seg, count)
        deg = np.zeros(size, np.int64)
        acc = np.zeros(size, np.int64)
        idx = np.arange(len(keys))
        for p in slots:
            np.add.at(deg, p, 1)
            np.bitwise_xor.at(acc, p, idx)
        rounds, left = [], len(keys)
        single = np.flatnonzero(deg == 1)
        while len(single):
            k, where = np.unique(acc[single], return_index=True)
            pivot = single[where]
            rounds.append((k, pivot))
            left -= len(k)
            for p in slots[:, k]:
                np.subtract.at(deg, p, 1)
                np.bitwise_xor.at(acc, p, k)
            touched = np.unique(slots[:, k])
            single = touched[deg[touched] == 1]
        if left == 0:
            break
        if attempt % 10 == 9:  # small sets may need more room
            count += 1
            size = (count + 2) * seg
    else:  # pragma: no cover
        raise RuntimeError("no filter found")
    b = np.zeros(size, np.uint8)
    for k, pivot in reversed(rounds):
        b[pivot] = 0
        b[pivot] = f[k] ^ b[slots[0, k]] ^ b[slots[1, k]] ^ b[slots[2, k]]
    return _HEAD.pack(seed, len(keys), seg, count) + b.tobytes()


def contains(blob: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter."""
    seed, n, seg, count = _HEAD.unpack_from(blob)
    if not n:
        return np.zeros(len(keys), bool)
    b = np.frombuffer(blob, np.uint8, offset=_HEAD.size)
    slots, f = _probes(np.asarray(keys, np.uint64), seed, seg, count)
    return (b[slots[0]] ^ b[slots[1]] ^ b[slots[2]]) == f
