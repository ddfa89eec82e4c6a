"""Suffix arrays by induced sorting, with permuted common prefixes, on numpy arrays.

Suffixes are classified as smaller (S) or larger (L) than their right neighbour.  The leftmost S
suffixes of each run (LMS) are put into their buckets, L suffixes are induced from left to right and
S suffixes from right to left, which sorts the LMS substrings.  Equal substrings get one name, the
string of names is sorted recursively, and a last pair of scans induces the whole array.  Buckets
are scanned one after another; everything inside a bucket is done for all its suffixes at once.
Where names are too many for buckets, ranks are doubled instead (the names' order is the same).
"""

from __future__ import annotations

import numpy as np

MOST_BUCKETS = 1024


def _types(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour; the last one counts as smaller."""
    n = len(s)
    smaller = np.ones(n, bool)
    rising = s[:-1] < s[1:]
    decided = np.flatnonzero(s[:-1] != s[1:])  # an equal neighbour decides as the next change does
    if n > 1:
        at = np.r_[0, np.cumsum(s[:-1] != s[1:])[:-1]]  # how many were decided before
        known = at < len(decided)
        smaller[:-1][known] = rising[decided[at[known]]]
        smaller[:-1][~known] = False
    return smaller


def _induce(s: np.ndarray, smaller: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from the LMS suffixes in their order."""
    n, ends = len(s), np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, np.int64)
    order = lms[np.argsort(s[lms], kind="stable")]
    lms_counts = np.bincount(s[lms], minlength=len(sizes))
    lms_starts = np.cumsum(lms_counts) - lms_counts
    heads = starts.copy()

    def put(found: np.ndarray) -> None:
        chars = s[found]
        by = np.argsort(chars, kind="stable")
        counts = np.bincount(chars, minlength=len(sizes))
        first = np.cumsum(counts) - counts
        sorted_chars = chars[by]
        sa[heads[sorted_chars] + np.arange(len(found)) - first[sorted_chars]] = found[by]
        heads[:] += counts

    for c in range(len(sizes)):
        done = starts[c]
        while done < heads[c]:
            block = sa[done:heads[c]]
            done = heads[c]
            found = block[block > 0] - 1
            found = found[~smaller[found]]
            if len(found):
                put(found)
        own = order[lms_starts[c]:lms_starts[c] + lms_counts[c]]
        found = own[own > 0] - 1  # the suffix before an LMS suffix is an L suffix
        if len(found):
            put(found)

    l_ends, tails = heads.copy(), ends.copy()

    def put_back(found: np.ndarray) -> None:
        """From the right end of the buckets; found runs from right to left."""
        chars = s[found]
        by = np.argsort(chars, kind="stable")
        counts = np.bincount(chars, minlength=len(sizes))
        first = np.cumsum(counts) - counts
        sorted_chars = chars[by]
        sa[tails[sorted_chars] - 1 - (np.arange(len(found)) - first[sorted_chars])] = found[by]
        tails[:] -= counts

    sa[0] = n - 1  # the end mark is the only suffix of its bucket
    tails[s[n - 1]] = starts[s[n - 1]]
    for c in range(len(sizes) - 1, -1, -1):
        done = ends[c]
        while done > tails[c]:
            block = sa[tails[c]:done][::-1]
            done = tails[c]
            found = block[block > 0] - 1
            found = found[smaller[found]]
            if len(found):
                put_back(found)
        block = sa[starts[c]:l_ends[c]][::-1]
        found = block[block > 0] - 1
        found = found[smaller[found]]
        if len(found):
            put_back(found)
    return sa


def _names(s: np.ndarray, ordered: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Names of the sorted LMS substrings; equal substrings share a name."""
    a, b = ordered[:-1], ordered[1:]
    la, lb = ends[a] - a, ends[b] - b
    same = la == lb
    alive, k = np.flatnonzero(same), 0
    while len(alive):
        differ = s[a[alive] + k] != s[b[alive] + k]
        same[alive[differ]] = False
        k += 1
        alive = alive[~differ]
        alive = alive[la[alive] >= k]
    return np.concatenate([[0], np.cumsum(~same)])


def _doubled(s: np.ndarray) -> np.ndarray:
    """Suffix array by doubling ranks."""
    rank, k = (s if s.max() < len(s) else np.unique(s, return_inverse=True)[1]).astype(np.int64), 1
    while True:
        second = np.zeros(len(s), np.int64)
        second[:-k] = rank[k:] + 1
        key = rank * (len(s) + 1) + second
        order = np.argsort(key)  # equal keys get one rank, whatever their order
        sorted_key = key[order]
        rank = np.empty(len(s), np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if rank[order[-1]] == len(s) - 1:
            return order
        k *= 2


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Of non-negative integers; the last one must be the only smallest."""
    n = len(s)
    if n < 2:
        return np.arange(n)
    s = s.astype(np.uint16 if s.max() < 65536 else np.int64, copy=False)
    sizes = np.bincount(s)
    if len(sizes) > MOST_BUCKETS:
        return _doubled(s)
    smaller = _types(s)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = smaller[1:] & ~smaller[:-1]
    lms = np.flatnonzero(is_lms)
    if len(lms) == 0:
        return _induce(s, smaller, np.array([n - 1]), sizes)
    sa = _induce(s, smaller, lms, sizes)
    ordered = sa[is_lms[sa]]
    ends = np.zeros(n, np.int64)
    ends[lms] = np.append(lms[1:], lms[-1])
    names = np.zeros(n, np.int64)
    names[ordered] = _names(s, ordered, ends)
    reduced = names[lms]
    if reduced.max() < len(lms) - 1:
        sorted_lms = lms[suffix_array(reduced)]
    else:
        sorted_lms = ordered
    return _induce(s, smaller, sorted_lms, sizes)


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each position the bytes its suffix shares with the one before it in the suffix array.

    Counted up to ``most`` and in text order; s: bytes, followed by at least ``most`` + 8 more.
    Where the array holds some suffixes only, the others' positions share nothing.
    """
    n = int(sa.max()) + 1 if len(sa) else 0
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    words = np.ndarray((len(s) - 7,), "<u8", s.tobytes(), strides=(1,))
    out = np.zeros(n, np.int64)
    alive = np.flatnonzero(before >= 0)
    for k in range(0, most, 8):
        differ = words[alive + k] ^ words[before[alive] + k]
        equal = differ == 0
        last = alive[~equal]
        low = differ[~equal]
        out[last] = k + (np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) >> 3)
        alive = alive[equal]
        out[alive] = k + 8
    return np.minimum(out, most)
