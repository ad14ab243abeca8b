"""Hashed byte n-grams of texts."""

from __future__ import annotations

import numpy as np

from cohortwise.llm.words import BASE, BYTE_VALUES

SPREAD = np.uint64(0xD1B54A32D192ED03)


def gram_codes(data: np.ndarray, size: int, bits: int) -> np.ndarray:
    """Code (of ``bits`` bits) of the ``size`` bytes from each position on."""
    n = len(data) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    values = BYTE_VALUES[data]
    out = values[:n] + np.uint64(size)
    for k in range(1, size):
        out *= BASE
        out += values[k : k + n]
    out *= SPREAD
    out ^= out >> np.uint64(32)
    out *= BASE
    return (out >> np.uint64(64 - bits)).astype(np.int64)


def text_codes(text: bytes, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Codes of all n-grams of one text."""
    data = np.frombuffer(text, np.uint8)
    return np.concatenate([gram_codes(data, s, bits) for s in sizes]) if len(data) else np.zeros(0, np.int64)
