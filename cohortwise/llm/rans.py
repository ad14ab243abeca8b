"""Interleaved range asymmetric numeral systems with a static table.

A block of ``n`` ids is coded in ``lanes`` independent states; id ``i`` belongs to lane ``i % lanes``
and step ``i // lanes``. A payload is, little-endian:

    4 bytes ``RNS1``; then unsigned 32-bit: scale bits, lanes, ids, steps per segment, segments
    per segment: unsigned 32-bit word offset and crc32 of its ids (as unsigned 32-bit integers)
    per segment: the state of every lane before its first step, unsigned 64-bit
    the code words, unsigned 32-bit

Segments are checkpoints: each can be decoded and verified by itself.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LOW = np.uint64(1 << 31)
MAGIC = b"RNS1"
WORD = np.uint64(32)


@dataclass(frozen=True)
class FrequencyTable:
    """Frequencies of all symbols, scaled to a sum of ``2**bits``; a symbol that occurs has one or more."""

    frequencies: np.ndarray
    bits: int

    @classmethod
    def of(cls, counts: np.ndarray, bits: int = 18) -> FrequencyTable:
        counts = np.asarray(counts, np.int64)
        present, total = counts > 0, int(counts.sum())
        if not total:
            return cls(np.zeros(len(counts), np.uint64), bits)
        while 2 * int(present.sum()) > 1 << bits:
            bits += 1
        scaled = np.maximum(np.floor(counts / total * (1 << bits)).astype(np.int64), present)
        spare = (1 << bits) - int(scaled.sum())
        order = np.argsort(-scaled, kind="stable")
        if spare > 0:
            scaled[order[0]] += spare
        while spare < 0:  # take back from the largest, never below one
            for s in order:
                give = min(-spare, int(scaled[s]) // 2)
                scaled[s] -= give
                spare += give
                if spare == 0 or scaled[s] <= 1:
                    break
        return cls(scaled.astype(np.uint64), bits)

    @cached_property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.frequencies)[:-1]]).astype(np.uint64)

    @cached_property
    def symbols(self) -> np.ndarray:
        """The symbol of each slot."""
        return np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies.astype(np.int64))


def lanes_for(n: int) -> int:
    return int(max(1, min(1024, n // 64)))


def encode(ids: np.ndarray, table: FrequencyTable, segment_ids: int = 1 << 17) -> bytes:
    ids = np.ascontiguousarray(ids, np.uint32)
    n = len(ids)
    lanes = lanes_for(n)
    steps = -(-n // lanes)
    per_segment = max(1, segment_ids // lanes)
    segments = -(-steps // per_segment)
    bits, shift = np.uint64(table.bits), np.uint64(63 - table.bits)
    frequency, start = table.frequencies[ids], table.starts[ids]
    state = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = [np.zeros(0, np.uint32)] * steps
    saved = np.empty((segments, lanes), np.uint64)
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min((step + 1) * lanes, n)
        f, x = frequency[a:b], state[: b - a]
        full = x >= (f << shift)
        words[step] = x[full].astype(np.uint32)
        x = np.where(full, x >> WORD, x)
        q = x // f
        state[: b - a] = (q << bits) + (x - q * f) + start[a:b]
        if step % per_segment == 0:
            saved[step // per_segment] = state
    at = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    size = per_segment * lanes
    index = np.array(
        [[at[k * per_segment], zlib.crc32(ids[k * size : (k + 1) * size])] for k in range(segments)], np.uint32
    )
    head = np.array([table.bits, lanes, n, per_segment, segments], np.uint32)
    return b"".join(
        [MAGIC, head.tobytes(), index.tobytes(), saved.tobytes(), *(w.tobytes() for w in words)]
    )


class Payload:
    """A coded block, to be decoded whole or by segments."""

    def __init__(self, data: bytes, table: FrequencyTable):
        if data[:4] != MAGIC:
            raise ValueError("not a coded block")
        bits, self.lanes, self.n, self.per_segment, self.segments = (
            int(v) for v in np.frombuffer(data, np.uint32, 5, 4)
        )
        if bits != table.bits:
            raise ValueError("the block was coded with another table")
        self.table = table
        at = 24
        self.index = np.frombuffer(data, np.uint32, 2 * self.segments, at).reshape(-1, 2)
        at += 8 * self.segments
        self.states = np.frombuffer(data, np.uint64, self.segments * self.lanes, at).reshape(-1, self.lanes)
        at += 8 * self.segments * self.lanes
        self.words = np.frombuffer(data, np.uint32, -1, at)

    def segment(self, k: int) -> np.ndarray:
        table, lanes = self.table, self.lanes
        bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
        first = k * self.per_segment * lanes
        out = np.empty(min(self.per_segment * lanes, self.n - first), np.uint32)
        state, at = self.states[k].copy(), int(self.index[k, 0])
        frequencies, starts, symbols, words = table.frequencies, table.starts, table.symbols, self.words
        for a in range(0, len(out), lanes):
            x = state[: len(out) - a]
            slot = x & mask
            symbol = symbols[slot]
            x = frequencies[symbol] * (x >> bits) + slot - starts[symbol]
            out[a : a + len(x)] = symbol
            empty = np.flatnonzero(x < LOW)
            x[empty] = (x[empty] << WORD) | words[at : at + len(empty)]
            at += len(empty)
            state[: len(x)] = x
        if zlib.crc32(out) != int(self.index[k, 1]):
            raise ValueError(f"checksum of segment {k} does not match")
        return out

    def ids(self) -> np.ndarray:
        parts = [self.segment(k) for k in range(self.segments)]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
