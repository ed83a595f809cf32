"""Hilbert keys of projected vectors (numpy)."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of integer points (rows x dimensions) below 2 ** bits."""
    x = cells.astype(np.uint64).T.copy()
    n = len(x)
    one = np.uint64(1)
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        low = q - one
        for i in range(n):
            hit = (x[i] & q) != 0
            swap = np.where(hit, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(hit, low, swap)
            x[i] ^= swap if i else np.uint64(0)
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        q = one << np.uint64(b)
        turn ^= np.where((x[n - 1] & q) != 0, q - one, np.uint64(0))
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(b)) & one)
    return key.astype(np.int64)
