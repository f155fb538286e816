"""Vectorised hashing of words and shingles over UTF-8 bytes.

Words are maximal runs of bytes other than ASCII white space, or than another set of ASCII bytes, which never
splits a UTF-8 sequence.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
ODD = U(0x9E3779B97F4A7C15)
INVERSE = U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CODE = np.random.default_rng(20240517).integers(0, 1 << 64, 256, dtype=np.uint64) | U(1)
_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """ODD**i and ODD**-i for i below n, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 16)
        up, down = np.full(size, ODD, np.uint64), np.full(size, INVERSE, np.uint64)
        up[0] = down[0] = 1
        grown = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        if size > 1 << 22:
            return grown
        _powers = grown
    return _powers


def classes(low: int) -> np.ndarray:
    """For each byte whether it parts words of A-Z, a-z, bytes from 0x80 and, with low = 0x30, digits."""
    out = np.ones(256, bool)
    out[[*range(low, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
    return out


def words(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, runs of bytes not in between, in byte order, and the first word of each row (one more at the end)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = ~between[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, its A-Z lower-cased."""
    up, down = powers(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(CODE[FOLD[data]] * up[: len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * ODD)


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of k words within rows, and where each row's begin.

    A row of one to k - 1 words has one, of its whole sequence.
    """
    counts = np.diff(first)
    many = np.maximum(counts - k + 1, 0)
    sizes = np.where((counts > 0) & (counts < k), 1, many)
    begin = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.zeros(begin[-1], np.uint64)
    with np.errstate(over="ignore"):
        if len(hashes) >= k:
            rolled = np.zeros(len(hashes) - k + 1, np.uint64)
            for i in range(k):
                rolled = mix(rolled * ODD + hashes[i : len(hashes) - k + 1 + i])
            # rows of k words and more: their windows lie side by side in both arrays
            whole = np.repeat(counts >= k, many)
            at = np.arange(many.sum()) + np.repeat(first[:-1] - (np.cumsum(many) - many), many)
            to = np.arange(many.sum()) + np.repeat(begin[:-1] - (np.cumsum(many) - many), many)
            out[to[whole]] = rolled[at[whole]]
        for r in np.flatnonzero((counts > 0) & (counts < k)):
            x = U(counts[r])
            for h in hashes[first[r] : first[r + 1]]:
                x = mix(np.array([x * ODD + h], np.uint64))[0]
            out[begin[r]] = x
    return out, begin


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int):
    """For each row the sorted distinct shingle hashes."""
    starts, ends, first = words(data, offsets)
    hashed, begin = shingle_hashes(word_hashes(data, starts, ends), first, k)
    for r in range(len(offsets) - 1):
        yield np.unique(hashed[begin[r] : begin[r + 1]])
