"""A keyed permutation of 0 .. n-1 for arrays."""

from __future__ import annotations

import hashlib

import numpy as np

from strata.llm.common import U64, mixed

ROUNDS = 6


def permuted(x: np.ndarray, n: int, key: str) -> np.ndarray:
    """The places of ``x`` (integers below ``n``) under the permutation that
    ``key`` selects: a balanced Feistel network over the next even number of
    bits, walked along its cycle until the place is below ``n`` (fewer than
    four steps on average)."""
    half = max(1, ((max(n, 2) - 1).bit_length() + 1) // 2)
    mask = U64((1 << half) - 1)
    keys = [U64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "little"))
            for r in range(ROUNDS)]
    out = np.asarray(x).astype(U64)
    todo = np.ones(len(out), bool)
    while todo.any():
        v = out[todo]
        left, right = v >> U64(half), v & mask
        for k in keys:
            left, right = right, left ^ (mixed(right ^ k) & mask)
        out[todo] = left << U64(half) | right
        todo = out >= U64(n)
    return out.astype(np.int64)
