"""A static hash map of int64 keys to int32 values in two numpy arrays, looked up a
whole array at a time. The arrays can be memory-mapped."""

from __future__ import annotations

import numpy as np

from .textkernel import mix

_FREE = np.int64(-1)


def build(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table of distinct keys, none of them negative; at most a quarter is full."""
    size = 1 << max(4, int(4 * len(keys) - 1).bit_length())
    slot_keys, slot_values = np.full(size, _FREE), np.zeros(size, np.int32)
    at = (mix(keys) & np.uint64(size - 1)).astype(np.int64)
    left = np.arange(len(keys))
    while len(left):
        free = slot_keys[at] == _FREE
        first = np.unique(at[free], return_index=True)[1]
        won = np.flatnonzero(free)[first]
        slot_keys[at[won]] = keys[left[won]]
        slot_values[at[won]] = values[left[won]]
        stay = np.ones(len(left), bool)
        stay[won] = False
        left, at = left[stay], (at[stay] + 1) & (size - 1)
    return slot_keys, slot_values


def find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray, missing: int = -1) -> np.ndarray:
    """The value of each key, or ``missing``."""
    slot_keys, slot_values = table
    size = len(slot_keys)
    out = np.full(len(keys), missing, np.int32)
    at = (mix(keys) & np.uint64(size - 1)).astype(np.int64)
    left = np.arange(len(keys))
    while len(left):
        there = slot_keys[at]
        hit = there == keys[left]
        out[left[hit]] = slot_values[at[hit]]
        go = ~hit & (there != _FREE)
        left, at = left[go], (at[go] + 1) & (size - 1)
    return out
