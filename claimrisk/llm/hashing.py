"""Hashes of words and word shingles, computed on whole texts with array operations."""

from __future__ import annotations

import numpy as np

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)  # what a byte adds to a hash
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(4096, 1 << int(n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = _POWERS[name] = np.multiply.accumulate(steps)
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Sums from which the hash of any stretch of bytes follows."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * _powers("base", BASE, len(data)), out=out[1:])
    return out


def stretches(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of bytes starts[i] to ends[i], the same wherever the bytes stand."""
    moved = (sums[ends] - sums[starts]) * _powers("inverse", INVERSE, len(sums))[starts]
    return mixed(moved + (ends - starts).astype(np.uint64))


def stretches_of(sums: np.ndarray, length: int) -> np.ndarray:
    """Hashes of all stretches of one length, in the order of their starts."""
    moved = (sums[length:] - sums[:-length]) * _powers("inverse", INVERSE, len(sums))[:len(sums) - length]
    return mixed(moved + np.uint64(length))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words: runs without blank, \\t, \\n, \\v, \\f, \\r."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def words_of(text: str, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (bytes) of every word; lower: letters A to Z count as a to z."""
    data = text.encode()
    data = np.frombuffer(data.lower() if lower else data, np.uint8)
    starts, ends = word_spans(data)
    return stretches(prefix_sums(data), starts, ends), starts, ends


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the stretches of k words; of all words as one if there are fewer, if any."""
    n = max(1, len(words) - k + 1) if len(words) else 0
    k = min(k, len(words))
    out = np.full(n, k, np.uint64)
    for i in range(k):
        out = out * BASE + words[i:i + n]
    return mixed(out)
