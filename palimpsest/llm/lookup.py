"""A table from 64-bit fingerprints to numbers that looks up whole arrays."""

from __future__ import annotations

import numpy as np


class Lookup:
    """Open addressing with linear probing; keys are distinct. ``get`` gives ``missing`` elsewhere."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, missing: int = -1) -> None:
        bits = max(4, (2 * len(keys)).bit_length())
        self.mask = np.uint64((1 << bits) - 1)
        self.missing = missing
        self.used = np.zeros(1 << bits, bool)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.values = np.full(1 << bits, missing, values.dtype if len(values) else np.int64)
        left, at = np.arange(len(keys)), (keys & self.mask).astype(np.int64)
        while len(left):
            free = ~self.used[at]
            slot, first = np.unique(at[free], return_index=True)
            put = left[free][first]
            self.used[slot], self.keys[slot], self.values[slot] = True, keys[put], values[put]
            rest = ~np.isin(left, put)
            left, at = left[rest], (at[rest] + 1) & int(self.mask)

    def get(self, keys: np.ndarray) -> np.ndarray:
        at = (keys & self.mask).astype(np.int64)
        out = np.full(len(keys), self.missing, self.values.dtype)
        left = np.arange(len(keys))
        while len(left):
            same = self.keys[at] == keys[left]
            used = self.used[at]
            hit = same & used
            out[left[hit]] = self.values[at[hit]]
            go = used & ~hit
            left, at = left[go], (at[go] + 1) & int(self.mask)
        return out
