"""Locally consistent parsing: phrase names that depend on the text around them only.

One level of the parse, for many texts at once:

1. A run of equal names becomes one name of its length, so that neighbours differ.
2. Deterministic coin tossing: a name is replaced by the place of the lowest bit in which it differs
   from the name before it, and that bit. Neighbours still differ. Four rounds take 64-bit names
   to six labels.
3. Labels 5, 4 and 3 are replaced by the least label that neither neighbour has.
4. Local maxima of the three labels begin phrases, so a phrase has a few names; its name is the hash of
   them.

Where a phrase begins depends on a bounded number of names on either side. Equal substrings are
therefore parsed equally except near their ends, at whatever offset they are, at every level.

A fingerprint is the hash of the whole parse and a sketch of the phrase names of one level: for each
of ``BINS`` hash ranges, eight bits of its least name hash, or zero if it has none.
"""

from __future__ import annotations

import numpy as np

from cohortwise.llm.words import BASE, BYTE_VALUES, mix, powers

BINS = 128
LEVELS = 4
SKETCHED = 3
NONE = 255


def _toss_table() -> np.ndarray:
    """New label for (label before, label)."""
    before, own = np.meshgrid(np.arange(256), np.arange(256), indexing="ij")
    differ = before ^ own
    place = np.zeros_like(differ)
    for bit in range(7, -1, -1):
        place[(differ >> bit) & 1 == 1] = bit
    return (2 * place + ((own >> place) & 1)).astype(np.uint8).reshape(-1)


def _free_table() -> np.ndarray:
    """Least of 0, 1, 2 that is neither the left nor the right label."""
    out = np.zeros((256, 256), np.uint8)
    for left in range(256):
        for right in range(256):
            out[left, right] = min({0, 1, 2} - {left, right})
    return out.reshape(-1)


TOSS, FREE = _toss_table(), _free_table()


def _shifted(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The label before each one; none before the first of a text."""
    out = np.empty_like(labels)
    out[1:] = labels[:-1]
    out[first] = NONE
    return out


def _following(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.empty_like(labels)
    out[:-1] = labels[1:]
    out[first[1:] - 1] = NONE
    out[-1] = NONE
    return out


def labels_of(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Three-valued labels that differ between neighbours; ``first`` has the texts' first positions."""
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[first] = ~names[first]
    differ = names ^ before
    low = differ & (~differ + np.uint64(1))
    place = (low.astype(np.float64).view(np.uint64) >> np.uint64(52)).astype(np.int64) - 1023
    bit = (names & low) != 0
    labels = (2 * place + bit).astype(np.uint8)
    for _ in range(3):
        labels = TOSS[(_shifted(labels, first).astype(np.uint16) << 8) | labels]
    for value in (5, 4, 3):
        at = np.flatnonzero(labels == value)
        if len(at):
            left, right = _shifted(labels, first)[at], _following(labels, first)[at]
            labels[at] = FREE[(left.astype(np.uint16) << 8) | right]
    return labels


def parse_level(names: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The phrase names of one level and where those of each text begin."""
    if not len(names):
        return names, bounds
    filled = bounds[:-1][bounds[1:] > bounds[:-1]]
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[filled] = True
    if not new.all():
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(names))).astype(np.uint64)
        names = np.where(length > 1, mix(names[at] * BASE + length), names[at])
        bounds = np.searchsorted(at, bounds, "left")
        filled = bounds[:-1][bounds[1:] > bounds[:-1]]
    labels = labels_of(names, filled)
    left, right = _shifted(labels, filled), _following(labels, filled)
    begins = (labels > np.where(left == NONE, 0, left)) & ((right == NONE) | (labels > right))
    begins[filled] = True
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(names))
    up, down = powers(len(names) + 1)
    sums = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(names * up[: len(names)], out=sums[1:])
    phrases = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return phrases, np.searchsorted(starts, bounds, "left")


def parse(data: np.ndarray, bounds: np.ndarray, levels: int = LEVELS) -> list[tuple[np.ndarray, np.ndarray]]:
    """The levels of the parse of each text (rows of ``bounds`` over the bytes ``data``)."""
    names, at = BYTE_VALUES[data], np.asarray(bounds, np.int64)
    out = []
    for _ in range(levels):
        names, at = parse_level(names, at)
        out.append((names, at))
    return out


def fingerprints(texts: list[bytes]) -> np.ndarray:
    """One row of bytes per text: 8 of the whole parse, then the sketch. An empty text has zeros."""
    n = len(texts)
    out = np.zeros((n, 8 + BINS), np.uint8)
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    if not len(data):
        return out
    levels = parse(data, bounds)
    names, at = levels[-1]
    up, down = powers(len(names) + 1)
    sums = np.zeros(len(names) + 1, np.uint64)
    np.cumsum(names * up[: len(names)], out=sums[1:])
    whole = mix((sums[at[1:]] - sums[at[:-1]]) * down[at[:-1]] + (bounds[1:] - bounds[:-1]).astype(np.uint64))
    whole[bounds[1:] == bounds[:-1]] = 0
    out[:, :8] = whole.astype(">u8").view(np.uint8).reshape(n, 8)
    names, at = levels[SKETCHED - 1]
    owner = np.repeat(np.arange(n), np.diff(at))
    hashed = mix(names ^ BASE)
    bin_ = (hashed >> np.uint64(57)).astype(np.int64)
    empty = np.uint64(0xFFFFFFFFFFFFFFFF)
    least = np.full(n * BINS, empty, np.uint64)
    np.minimum.at(least, owner * BINS + bin_, hashed & np.uint64((1 << 57) - 1))
    value = (mix(least) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    out[:, 8:] = np.where(least == empty, 0, value).reshape(n, BINS)
    return out


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of phrases that two fingerprints have in common, from 0 to 1, row by row.

    With ``s`` the share of the bins in use that agree, which estimates the similarity of the phrase
    sets, it is ``2 s / (1 + s)``: one half for texts of equal length that share a half. Equal
    fingerprints have 1, an empty text and another one 0.
    """
    a, b = x[:, 8:], y[:, 8:]
    used = ((a > 0) | (b > 0)).sum(1)
    s = ((a == b) & (a > 0)).sum(1) / np.maximum(used, 1)
    return np.where((x == y).all(1), 1.0, 2 * s / (1 + s))
