"""Hashed character n-grams of texts, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD1342543DE82EF95)
#: Code points hashed at a time.
CHUNK = 1 << 18


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)


def buckets(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """The bucket, below 2**bits, of every n-gram of each size; repeats included."""
    shift = np.uint64(64 - bits)
    parts, rolled = [], points
    for size in range(1, max(sizes) + 1):
        if size > 1:
            rolled = rolled[:-1] * _STEP + points[size - 1 :] + np.uint64(size)
        if not len(rolled):
            break
        if size in sizes:
            parts.append(((rolled * _MIX) ^ (rolled >> np.uint64(29))) * _STEP >> shift)
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, dtype=np.int64)


def chunks(text: str, longest: int) -> Iterator[np.ndarray]:
    """Code points of overlapping stretches of a text that together hold each n-gram of up to ``longest``; shorter ones of the overlaps twice."""
    for at in range(0, max(len(text) - longest + 1, 1), CHUNK):
        yield code_points(text[at : at + CHUNK + longest - 1])


class Distinct:
    """Drops repeats from arrays of buckets, without sorting."""

    def __init__(self, bits: int):
        self.last = np.zeros(1 << bits, dtype=np.int64)

    def __call__(self, values: np.ndarray) -> np.ndarray:
        order = np.arange(len(values))
        self.last[values] = order
        return values[self.last[values] == order]
