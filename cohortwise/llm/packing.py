"""Packing of tokenized documents into sequences by first-fit decreasing.

A document longer than a sequence is cut into full pieces and a rest. Pieces are dealt to random
groups of about ``group_pieces`` by a seeded hash; in each group they are taken by falling length,
each into the first sequence with enough room. A tournament tree over the remaining capacities finds
that sequence in a logarithmic number of steps. Groups are independent tasks of bounded size, and
only numbers are shuffled, no ids.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, run_starts, whole_groups, written
from cohortwise.llm.tokens import encoder, read_description

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


@dataclass(frozen=True)
class PackSettings:
    tokenizer: str
    cut: str = "spaced"
    end_id: int = 1
    sequence: int = 2048
    group_pieces: int = 4096
    seed: int = 7


class CapacityTree:
    """Remaining capacities of bins in order; each inner node knows the largest below it."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def first_fit(self, size: int) -> tuple[int, int]:
        """Put ``size`` into the first bin that has room; returns the bin and the room it had."""
        room, node, leaves = self.room, 1, self.leaves
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        had = room[node]
        room[node] = had - size
        bin_ = node - leaves
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
        return bin_, had


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each of ``lengths`` (falling, each at most ``capacity``)."""
    n = len(lengths)
    bins, offsets = np.empty(n, np.int64), np.zeros(n, np.int64)
    full = int(np.searchsorted(-lengths, -capacity, "right"))  # pieces that fill a bin alone
    bins[:full] = np.arange(full)
    tree = CapacityTree(n - full, capacity)
    for k, size in enumerate(lengths[full:].tolist(), full):
        at, had = tree.first_fit(size)
        bins[k], offsets[k] = full + at, capacity - had
    return bins, offsets


def document_pieces(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """The pieces of every document with the crc32 of their ids; ``row`` tells rows apart."""
    description = docs.sparkSession.sparkContext.broadcast(read_description(settings.tokenizer))
    cut, end, size = settings.cut, settings.end_id, settings.sequence

    def work(batches):
        encode_text = encoder(description.value, cut)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            out = []
            every, bounds = encode_text.encode_column(batch.column("text"))
            bounds = bounds.tolist()
            for key, a, b in zip(batch.column("doc_id").to_pylist(), bounds, bounds[1:]):
                ids = np.empty(b - a + 1, "<u4")
                ids[:-1], ids[-1] = every[a:b], end
                for s in range(0, len(ids), size):
                    part = ids[s : s + size]
                    out.append((key, s, len(part), zlib.crc32(part), len(ids), row))
                row += 1
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, work, PIECES)


def packed(pieces: DataFrame, settings: PackSettings) -> DataFrame:
    """``sequence_id`` and ``offset`` of every piece, and what its sequence is padded to."""
    capacity = settings.sequence
    groups = pieces.count() // settings.group_pieces + 1

    def work(batches):
        for table in whole_groups(batches, ["group"]):
            group, length = table.column("group").to_numpy(), table.column("length").to_numpy()
            sequence, offset, used = (np.empty(len(group), np.int64) for _ in range(3))
            edges = run_starts(group)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                bins, offset[a:b] = first_fit_decreasing(length[a:b], capacity)
                sequence[a:b] = (group[a] << 32) + bins
                used[a:b] = np.bincount(bins, length[a:b]).astype(np.int64)[bins]
            padded = np.where(used & (used - 1) == 0, used, capacity)
            kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks() for c in kept]
                + [pa.array(sequence), pa.array(offset), pa.array(padded)],
                names=[*kept, "sequence_id", "offset", "padded_length"],
            )

    order = [F.col("group"), F.col("length").desc(), "doc_id", "start", "row"]
    dealt = (
        pieces.withColumn("group", F.pmod(F.xxhash64("row", "start", F.lit(settings.seed)), F.lit(groups)))
        .repartition("group")
        .sortWithinPartitions(*order)
    )
    return arrow_map(
        dealt,
        work,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
        "offset long, padded_length long",
    )


def pack_documents(docs: DataFrame, settings: PackSettings) -> DataFrame:
    """Where each piece of each document lies; one row per piece.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text is an empty one: a
    piece with its end id alone. Rows that repeat an id, or have none, are packed as rows of their
    own. An empty table gives an empty one. A sequence is padded to ``sequence`` ids unless its length
    is a power of two.
    """
    return packed(written(document_pieces(docs, settings)), settings)


def sequences(docs: DataFrame, placed: DataFrame, settings: PackSettings) -> DataFrame:
    """``sequence_id``, ``ids`` (unsigned 32-bit, without padding) of the packed sequences.

    The texts are tokenized again and their pieces shuffled to their sequences. A piece is found by all that
    ``placed`` says of it, its checksum included; rows of ``docs`` that agree in that, such as the copies of a mix,
    hold the same ids, so each placed piece takes them once. Rows may repeat an id or have none.
    """
    same = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    description = docs.sparkSession.sparkContext.broadcast(read_description(settings.tokenizer))
    cut, end, size = settings.cut, settings.end_id, settings.sequence

    def work(batches):
        encode_text = encoder(description.value, cut)
        for batch in batches:
            out = []
            for key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.append(encode_text.ids(text), end).astype("<u4")
                for s in range(0, len(ids), size):
                    part = ids[s : s + size]
                    out.append((key, s, len(part), zlib.crc32(part), len(ids), part.tobytes()))
            columns = list(zip(*out)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(columns[5], pa.binary())],
                names=[*same, "ids"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = arrow_map(rows, work, ", ".join([*(f"{c} long" for c in same), "ids binary"]))
    once = parts.groupBy(*(F.col(c).alias(f"_{c}") for c in same)).agg(F.min("ids").alias("ids"))
    found = [placed[c].eqNullSafe(once[f"_{c}"]) for c in same]
    return (
        placed.join(once, found)
        .groupBy("sequence_id")
        .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select(
            "sequence_id",
            F.aggregate("parts", F.lit(b"").cast("binary"), lambda done, p: F.concat(done, p["ids"])).alias("ids"),
        )
    )
