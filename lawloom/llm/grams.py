"""Hashed character n-grams of whole texts, many at a time in numpy."""

from __future__ import annotations

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    """Code points."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def hashed(c: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Buckets of all n-grams of the given sizes, repeats included."""
    out = []
    h = np.zeros(len(c), np.uint64)
    shift = np.uint64(64 - bits)
    for n in range(1, max(sizes) + 1):
        if len(c) < n:
            break
        h = (h[: len(c) - n + 1] + c[n - 1 :] + np.uint64(n)) * _MIX
        h ^= h >> np.uint64(29)
        if n in sizes:
            out.append((h * _MIX) >> shift)
    return np.concatenate(out).astype(np.int32) if out else np.zeros(0, np.int32)


def present(c: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """The distinct buckets, rising."""
    return np.unique(hashed(c, sizes, bits))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))
