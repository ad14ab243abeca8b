"""Words of many texts at once, as 64-bit hashes.

A word is a maximal run of bytes other than space and ``\\x09``-``\\x0D``. Its hash is a polynomial
over the bytes modulo 2**64, taken from prefix sums over the whole batch, then mixed. Two
words of one comparison meet by accident with a chance of about 2**-64.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
LONG = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64, a bijection of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE) | np.uint64(1)


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    up, down = np.full(size, BASE, np.uint64), np.full(size, inverse, np.uint64)
    up[0] = down[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(20, int(n).bit_length())
    return _powers(size)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[s:e]`` for each span."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    raw = (sums[ends] - sums[starts]) * down[starts]
    return mix(raw + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; a word never crosses the end of a text."""
    inside = ~SEPARATOR[data]
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < n)]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hash_words(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and where the words of each text begin.

    A very long text is taken in parts that end between words.
    """
    rows = len(bounds) - 1
    if rows == 1 and len(data) > LONG:
        parts, at = [], 0
        while at < len(data):
            stop = min(at + LONG, len(data))
            if stop < len(data):
                cut = np.flatnonzero(SEPARATOR[data[at:stop]])
                while not len(cut) and stop < len(data):  # a word longer than a part
                    more = min(stop + LONG, len(data))
                    cut = np.flatnonzero(SEPARATOR[data[at:more]])
                    stop = more
                stop = at + int(cut[-1]) + 1 if len(cut) else len(data)
            part = data[at:stop]
            parts.append(_hash(part, np.array([0, len(part)]), lower)[0])
            at = stop
        joined = np.concatenate(parts)
        return joined, np.array([0, len(joined)])
    return _hash(data, bounds, lower)


def _hash(data, bounds, lower):
    starts, ends = word_spans(data, bounds)
    hashes = span_hashes(LOWER[data] if lower else data, starts, ends)
    return hashes, np.searchsorted(starts, bounds, "left")


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words (empty if there are fewer)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out = mix(out * BASE + words[k : k + n])
    return out
