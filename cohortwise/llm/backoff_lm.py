"""Language-model scores by a weighted backoff automaton over the whole corpus.

The states are the words seen in training and one empty state. A seen bigram is an arc from its
first word; a word without the arc wanted fails over to the empty state, where every word has an
arc. With ``c`` the training counts, ``N`` tokens and ``V`` distinct ones,

    empty state:   p(w)     = (c(w) + 1) / (N + V + 1)
    arc of v:      p(w | v) = (1 - e) * c(v, w) / c(v) + e * p(w)
    failure of v:  e * p(w),  or p(w) itself when v was never seen

``e`` is the chance of leaving state ``v``, one number for all states whose count has the same
number of bits: the share of their training tokens that would be new if left out, which is how
often the bigram is a single one. Probabilities of a state sum to one.

Counts never travel to the driver. Texts are cut into blocks; each block sends its distinct
n-grams, packed as arrays, to slices of the hash space, where they are summed over all blocks,
and gets back the totals for just those n-grams: the part of the automaton that its texts
can reach. A frequent word is one entry per block, so nothing about it is hot. The token streams
and the totals are tables bucketed by block, so the passes over them shuffle nothing.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, bytes_of, crc32_of_id, pieces, run_starts, whole_groups, written
from cohortwise.llm.words import BASE, hash_words, mix

END = np.uint64(0x5CF1A20C9E3779B9)
BEGIN = np.uint64(0x1B873593CC9E2D51)
CLASSES = 64


@dataclass(frozen=True)
class LmSettings:
    """Text bytes of a block, and n-gram entries summed in one group."""

    block_bytes: int = 4 << 20
    slice_entries: int = 1_000_000


def _narrow(values: np.ndarray) -> np.ndarray:
    top = int(values.max()) if len(values) else 0
    return values.astype(np.uint8 if top < 256 else np.uint16 if top < 65536 else np.uint32 if top < 1 << 32 else np.uint64)


def _pack(values: np.ndarray) -> bytes:
    small = _narrow(values)
    return bytes([small.itemsize]) + small.tobytes()


def _unpack(data: bytes) -> np.ndarray:
    kind = {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[data[0]]
    return np.frombuffer(data, kind, offset=1)


def token_blocks(docs: DataFrame, settings: LmSettings) -> DataFrame:
    """One row per block of texts: its ids, its words by falling frequency, and its token stream.

    A token is the rank of its word in the block. Each text ends with the end token.
    """

    def block_row(number, ids, held, hashes, counts):
        stream = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        words, index, often = np.unique(stream, return_inverse=True, return_counts=True)
        order = np.argsort(-often, kind="stable")
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words))
        tokens = rank[index]
        held = np.array(held, bool)
        train = int(np.array(counts, np.int64)[~held].sum())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held.astype(np.uint8).tobytes()], pa.binary()),
                pa.array([np.array(counts, np.int64).tobytes()], pa.binary()),
                pa.array([words[order].tobytes()], pa.binary()),
                pa.array([_pack(tokens)], pa.binary()),
                pa.array([len(tokens)], pa.int64()),
                pa.array([train], pa.int64()),
                pa.array([int((~held).sum())], pa.int64()),
            ],
            names=["block", "ids", "held", "counts", "words", "tokens", "n_tokens", "n_train", "n_texts"],
        )

    def work(batches):
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 32
        ids, held, hashes, counts, size = [], [], [], [], 0
        for batch in batches:
            data, bounds = bytes_of(batch.column("text"))
            keys, flags = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for a, b in pieces(bounds):
                part = bounds[a : b + 1]
                words, at = hash_words(data[part[0] : part[-1]], part - part[0], lower=True)
                hashes.append(np.insert(words, at[1:], END))
                counts += (np.diff(at) + 1).tolist()
                ids += keys[a:b]
                held += flags[a:b]
                size += int(part[-1] - part[0])
                if size >= settings.block_bytes:
                    yield block_row(number, ids, held, hashes, counts)
                    number += 1
                    ids, held, hashes, counts, size = [], [], [], [], 0
        if ids:
            yield block_row(number, ids, held, hashes, counts)

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(crc32_of_id(F.col("doc_id")) % 7 == 2, F.lit(False)).alias("held_out"),
    )
    return arrow_map(
        rows,
        work,
        "block long, ids array<long>, held binary, counts binary, words binary, tokens binary, "
        "n_tokens long, n_train long, n_texts long",
    )


class BlockGrams:
    """The distinct words and bigrams of one block, and the slices that sum them."""

    def __init__(self, row, slices: int):
        self.words = np.frombuffer(row["words"], np.uint64)
        self.tokens = _unpack(row["tokens"]).astype(np.int32)
        self.counts = np.frombuffer(row["counts"], np.int64)
        self.held = np.frombuffer(row["held"], np.uint8).astype(bool)
        self.ends = np.cumsum(self.counts)
        self.starts = self.ends - self.counts
        width = len(self.words) + 1
        self.before = np.empty(len(self.tokens), np.int32)  # 0: begin, else rank + 1
        self.before[1:] = self.tokens[:-1] + 1
        self.before[self.starts] = 0
        self.in_train = np.repeat(~self.held, self.counts)
        pair = self.before.astype(np.int64) * width + self.tokens
        order = np.argsort(pair)
        pair = pair[order]
        new = np.ones(len(pair), bool)
        new[1:] = pair[1:] != pair[:-1]
        self.pair_of = np.empty(len(order), np.int32)
        self.pair_of[order] = np.cumsum(new, dtype=np.int32) - 1
        pair = pair[new]
        self.first, self.second = (pair // width).astype(np.int32), (pair % width).astype(np.int32)
        contexts = np.append(BEGIN, self.words)
        keys = mix(contexts[self.first] * BASE + self.words[self.second])
        self.keys = np.concatenate([self.words, keys])
        slice_of = ((self.keys >> np.uint64(32)) * np.uint64(slices)) >> np.uint64(32)
        self.order = np.argsort(slice_of.astype(np.uint32), kind="stable")
        self.bounds = np.searchsorted(slice_of[self.order], np.arange(slices + 1, dtype=np.uint64))

    def train_counts(self) -> np.ndarray:
        words = np.bincount(self.tokens[self.in_train], minlength=len(self.words))
        pairs = np.bincount(self.pair_of[self.in_train], minlength=len(self.first))
        return np.concatenate([words, pairs])


def _six(keys: np.ndarray) -> bytes:
    """The low six bytes of each key; the slice stands for the rest."""
    return keys.view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _of_six(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).reshape(-1)


def gram_slices(blocks: DataFrame, slices: int) -> DataFrame:
    """What each block sends to each slice: words, bigrams, and their training counts in that order."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                grams = BlockGrams(row, slices)
                keys, counts = grams.keys[grams.order], grams.train_counts()[grams.order]
                is_word = grams.order < len(grams.words)
                words, pairs, got = [], [], []
                used = np.flatnonzero(np.diff(grams.bounds))
                for s in used:
                    a, b = grams.bounds[s], grams.bounds[s + 1]
                    cut = a + int(is_word[a:b].sum())  # the order is stable: words come first
                    words.append(keys[a:cut].tobytes())
                    pairs.append(_six(keys[cut:b]))
                    got.append(_pack(counts[a:b]))
                for at in range(0, len(used), 64):
                    part = slice(at, at + 64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(used[part], pa.int32()),
                            pa.array([row["block"]] * len(used[part]), pa.int64()),
                            pa.array(words[part], pa.binary()),
                            pa.array(pairs[part], pa.binary()),
                            pa.array(got[part], pa.binary()),
                        ],
                        names=["slice", "block", "words", "pairs", "counts"],
                    )

    return arrow_map(
        blocks.select("block", "held", "counts", "words", "tokens"),
        work,
        "slice int, block long, words binary, pairs binary, counts binary",
        batches=False,
    )


def _sum_equal(parts: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], int]:
    """The total of each key over all parts, part by part, and how many keys have a total."""
    keys = np.concatenate(parts)
    if not len(keys):
        return [np.zeros(0, np.int64)] * len(parts), 0
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = keys[1:] != keys[:-1]
    total = np.add.reduceat(np.concatenate(counts)[order].astype(np.int64), np.flatnonzero(new))
    back = np.empty(len(order), np.int64)
    back[order] = total[np.cumsum(new) - 1]
    return np.split(back, np.cumsum([len(p) for p in parts])[:-1]), int((total > 0).sum())


def summed(parts: DataFrame) -> DataFrame:
    """Totals over all blocks, sent back to each block in the order of its keys.

    ``known`` is the number of distinct training words of the slice, on one row of each slice.
    """

    def work(batches):
        for table in whole_groups(batches, ["slice"]):
            numbers = table.column("slice").to_numpy()
            edges = run_starts(numbers)
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                group = table.slice(a, b - a)
                words = [np.frombuffer(v.as_py(), np.uint64) for v in group.column("words")]
                pairs = [_of_six(v.as_py()) for v in group.column("pairs")]
                counts = [_unpack(v.as_py()) for v in group.column("counts")]
                words_back, known = _sum_equal(words, [c[: len(w)] for c, w in zip(counts, words)])
                pairs_back, _ = _sum_equal(pairs, [c[len(w) :] for c, w in zip(counts, words)])
                packed = [_pack(np.concatenate(both)) for both in zip(words_back, pairs_back)]
                yield pa.RecordBatch.from_arrays(
                    [
                        group.column("block").combine_chunks(),
                        group.column("slice").combine_chunks(),
                        pa.array(packed, pa.binary()),
                        pa.array([known] + [0] * (b - a - 1), pa.int64()),
                    ],
                    names=["block", "slice", "totals", "known"],
                )

    ready = parts.repartition("slice").sortWithinPartitions("slice")
    return arrow_map(ready, work, "block long, slice int, totals binary, known long", batches=False)


def _by_block(df: DataFrame, buckets: int) -> DataFrame:
    """A table in the warehouse, bucketed by block, so that joins on the block need no shuffle."""
    name = f"llm_blocks_{uuid.uuid4().hex}"
    # rows are megabytes: small row groups bound what a writer and a reader hold
    writer = df.write.bucketBy(buckets, "block").option("compression", "zstd").option("parquet.block.size", str(4 << 20))
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _class_of(counts: np.ndarray) -> np.ndarray:
    """Number of bits of each count."""
    return np.frexp(counts.astype(np.float64))[1]


def _totals(row, grams: BlockGrams) -> tuple[np.ndarray, np.ndarray]:
    parts = [_unpack(p["totals"]) for p in sorted(row["parts"], key=lambda p: p["slice"])]
    total = np.empty(len(grams.keys), np.int64)
    total[grams.order] = np.concatenate(parts)
    return total[: len(grams.words)], total[len(grams.words) :]


def leaving(joined: DataFrame, slices: int, texts: int) -> np.ndarray:
    """The chance of leaving a state, by the number of bits of its count."""

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                grams = BlockGrams(row, slices)
                words, pairs = _totals(row, grams)
                mine = grams.train_counts()[len(words) :]
                context = _class_of(np.append(texts, words)[grams.first])
                tokens = np.bincount(context, mine, CLASSES)
                single = np.bincount(context, (pairs == 1) & (mine == 1), CLASSES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(CLASSES), pa.int32()), pa.array(tokens.astype(np.int64)), pa.array(single.astype(np.int64))],
                    names=["bits", "tokens", "single"],
                )

    sums = arrow_map(joined, work, "bits int, tokens long, single long", batches=False).groupBy("bits").agg(
        F.sum("tokens").alias("tokens"), F.sum("single").alias("single")
    )
    out = np.ones(CLASSES)
    for row in sums.collect():  # 64 rows at every size
        out[row.bits] = (row.single + 1) / (row.tokens + 2)
    return out


class Automaton:
    """The part of the model that one block can reach: arc and failure weights as log10."""

    def __init__(self, words, pairs, grams: BlockGrams, leave: np.ndarray, tokens: int, known: int, texts: int):
        low = (words + 1) / (tokens + known + 1)
        self.empty = np.log10(low)
        history = np.append(texts, words)
        escape = np.where(history > 0, leave[_class_of(history)], 1.0)
        self.failure = np.log10(escape)
        seen = pairs > 0
        own = np.where(seen, pairs / np.maximum(history[grams.first], 1), 0.0)
        e = escape[grams.first]
        self.is_arc = seen
        self.arc = np.where(seen, np.log10((1 - e) * own + e * low[grams.second]), 0.0)

    def walk(self, grams: BlockGrams) -> np.ndarray:
        """Weight of each step, left to right.

        The state before a token is the word before it, so the steps of a traversal are known
        beforehand and are weighed all at once.
        """
        step = grams.pair_of
        fallback = self.failure[grams.before] + self.empty[grams.tokens]
        return np.where(self.is_arc[step], self.arc[step], fallback)


ROW_LIMITS = {"spark.sql.parquet.columnarReaderBatchSize": "4", "spark.sql.execution.arrow.maxBytesPerBatch": str(2 << 20)}


@contextmanager
def wide_rows(spark: SparkSession):
    """Read and send rows of megabytes a few at a time; settings are put back afterwards."""
    before = {k: spark.conf.get(k) for k in ROW_LIMITS}
    for k, v in ROW_LIMITS.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def language_model_scores(docs: DataFrame, settings: LmSettings = LmSettings()) -> DataFrame:
    """``doc_id held_out n_tokens n_known train_tokens base_score score`` per row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``; other columns are ignored. A null text is empty and
    still has its end token. A row without an id is learned from. Rows that repeat an id are rows
    of their own. An empty table gives an empty one; with no training rows every word is unseen.
    """
    buckets = max(8, docs.rdd.getNumPartitions())
    blocks = _by_block(token_blocks(docs, settings), buckets)
    with wide_rows(docs.sparkSession):
        size = blocks.agg(
            F.sum("n_tokens").alias("tokens"), F.sum("n_train").alias("train"), F.sum("n_texts").alias("texts")
        ).first()
        train, texts = int(size.train or 0), int(size.texts or 0)
        slices = int(size.tokens or 0) // settings.slice_entries + buckets
        back = summed(gram_slices(blocks, slices)).repartition(buckets, "block").groupBy("block")
        totals = _by_block(
            back.agg(F.collect_list(F.struct("slice", "totals")).alias("parts"), F.sum("known").alias("known")), buckets
        )
        known = int(totals.agg(F.sum("known").alias("known")).first().known or 0)
        joined = blocks.join(totals, "block").select("ids", "held", "counts", "words", "tokens", "parts")
        leave = leaving(joined.drop("ids"), slices, texts)

        def work(batches):
            for batch in batches:
                for row in batch.to_pylist():
                    grams = BlockGrams(row, slices)
                    words, pairs = _totals(row, grams)
                    model = Automaton(words, pairs, grams, leave, train, known, texts)
                    steps = model.walk(grams)
                    sums = [
                        np.add.reduceat(x, grams.starts)
                        for x in ((words[grams.tokens] > 0).astype(np.int64), model.empty[grams.tokens], steps)
                    ]
                    n = len(grams.counts)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row["ids"], pa.int64()),
                            pa.array(grams.held),
                            pa.array(grams.counts),
                            pa.array(sums[0]),
                            pa.array(np.full(n, train, np.int64)),
                            pa.array(sums[1]),
                            pa.array(sums[2]),
                        ],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                    )

        scores = written(
            arrow_map(
                joined,
                work,
                "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, score double",
                batches=False,
            )
        )
    for table in (blocks, totals):
        _drop(table)
    return scores


def _drop(table: DataFrame) -> None:
    files = table.inputFiles()
    if files:
        name = next(p for p in files[0].split("/") if p.startswith("llm_blocks_"))
        table.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
