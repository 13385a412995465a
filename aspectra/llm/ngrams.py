"""Hashed character n-grams in numpy, shared by the two classifiers."""

from __future__ import annotations

import numpy as np

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], dtype=np.uint64)


def code_points(text: str) -> np.ndarray:
    """Code points of ``text`` in lower case, framed by spaces; white space is a space."""
    t = " " + " ".join(text.lower().split()) + " "
    return np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype="<u4")


def hashed(points: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket (0 .. 2**bits - 1) of every n-gram of the code points; n is 1 to 5."""
    size = len(points) - n + 1
    if size <= 0:
        return np.empty(0, dtype=np.int64)
    p = points.astype(np.uint64)
    h = p[:size] * _ODD[0]
    for i in range(1, n):
        h = (h ^ (h >> np.uint64(29))) + p[i:i + size] * _ODD[i]
    h = (h ^ (h >> np.uint64(32))) * _ODD[1] + np.uint64(n)
    return (h >> np.uint64(64 - bits)).astype(np.int64)
