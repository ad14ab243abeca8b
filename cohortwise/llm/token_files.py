"""Files of token ids in document order, entropy-coded in blocks that can be read independently.

``write_token_files`` makes a folder with two tables:

``table``
    one row: the tokenizer's frequency table, shared by all blocks.
``blocks``
    one row per block of whole documents: ``shard`` and ``block`` (ascending document order),
    ``first`` (ids of all blocks before), ``doc_ids``, ``doc_tokens`` (ids of each document) and
    ``payload`` (see ``rans``). A block ends at the first document end past ``block_ids`` ids.

Documents are dealt to shards by ranges of ``doc_id``; the shards tokenize, and the blocks are kept
as a table while frequencies are counted over all of them. Every task can be repeated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, written
from cohortwise.llm.rans import FrequencyTable, Payload, encode
from cohortwise.llm.tokens import encoder, read_description
from cohortwise.session import scratch_folder


@dataclass(frozen=True)
class TokenFileSettings:
    """Tokenizer file, how its texts may be cut, id after each document, ids of a block, table bits."""

    tokenizer: str
    cut: str = "words"
    end_id: int = 1
    block_ids: int = 1 << 19
    bits: int = 18


def tokenized(docs: DataFrame, settings: TokenFileSettings) -> DataFrame:
    """Blocks of raw ids in document order: ``shard block offset n doc_ids doc_tokens ids``."""
    spark = docs.sparkSession
    description = spark.sparkContext.broadcast(read_description(settings.tokenizer))
    cut, end, limit = settings.cut, settings.end_id, settings.block_ids

    def work(batches):
        encode_text = encoder(description.value, cut)
        last = np.array([end], encode_text.kind).tobytes()
        shard = TaskContext.get().partitionId()
        block = offset = held = 0
        keys, counts, parts = [], [], []

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([block], pa.int64()),
                    pa.array([offset], pa.int64()),
                    pa.array([held], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())),
                    pa.array([counts], pa.list_(pa.int64())),
                    pa.array([b"".join(parts)], pa.binary()),
                ],
                names=["shard", "block", "offset", "n", "doc_ids", "doc_tokens", "ids"],
            )

        for batch in batches:
            found, bounds = encode_text.encode_column(batch.column("text"))
            bounds = bounds.tolist()
            for key, a, b in zip(batch.column("doc_id").to_pylist(), bounds, bounds[1:]):
                parts += (found[a:b].tobytes(), last)
                keys.append(key)
                counts.append(b - a + 1)
                held += counts[-1]
                if held >= limit:
                    yield row()
                    block, offset, held = block + 1, offset + held, 0
                    keys, counts, parts = [], [], []
        if held:
            yield row()

    shards = max(1, docs.rdd.getNumPartitions())
    order = ["doc_id", "tie", "place"]
    # rows that repeat an id are told apart, so that no id, however frequent, makes one large shard
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .withColumn("place", F.monotonically_increasing_id())
        .repartitionByRange(shards, *order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    return arrow_map(
        rows,
        work,
        "shard int, block long, offset long, n long, doc_ids array<long>, doc_tokens array<long>, ids binary",
    )


def symbol_counts(blocks: DataFrame) -> np.ndarray:
    """How often each id occurs in all blocks; the driver gets one number per id of the vocabulary."""

    def work(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for data, n in zip(batch.column("ids").to_pylist(), batch.column("n").to_pylist()):
                ids = np.frombuffer(data, f"<u{len(data) // n}")
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
        symbols = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(symbols.astype(np.int32)), pa.array(total[symbols])], names=["symbol", "count"]
        )

    rows = (
        arrow_map(blocks.select("n", "ids"), work, "symbol int, count long")
        .groupBy("symbol")
        .agg(F.sum("count").alias("count"))
        .collect()
    )
    counts = np.zeros(max((r.symbol for r in rows), default=0) + 1, np.int64)
    for r in rows:
        counts[r.symbol] = r["count"]
    return counts


def write_token_files(docs: DataFrame, folder: str, settings: TokenFileSettings) -> None:
    """Tokenize ``docs`` (``doc_id``, ``text``) into ``folder``.

    Other columns are ignored. A null text is an empty one: its end id alone. Rows without an id come
    first; rows that repeat an id stay rows of their own, in the order of a hash of their texts. An
    empty table gives a folder without blocks. A document longer than a block is a block.
    """
    spark = docs.sparkSession
    blocks = written_ids(docs, settings)
    counts = symbol_counts(blocks)
    table = FrequencyTable.of(counts, settings.bits)
    shards = blocks.groupBy("shard").agg(F.sum("n").alias("n")).orderBy("shard").collect()  # one row a task
    before, first = 0, {}
    for r in shards:
        first[r.shard] = before
        before += r.n

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = np.frombuffer(r["ids"], f"<u{len(r['ids']) // r['n']}")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r["shard"]], pa.int32()),
                        pa.array([r["block"]], pa.int64()),
                        pa.array([first[r["shard"]] + r["offset"]], pa.int64()),
                        pa.array([r["doc_ids"]], pa.list_(pa.int64())),
                        pa.array([r["doc_tokens"]], pa.list_(pa.int64())),
                        pa.array([encode(ids, table)], pa.binary()),
                    ],
                    names=["shard", "block", "first", "doc_ids", "doc_tokens", "payload"],
                )

    coded = arrow_map(
        blocks, work, "shard int, block long, first long, doc_ids array<long>, doc_tokens array<long>, payload binary"
    )
    coded.write.parquet(f"{folder}/blocks")
    spark.createDataFrame(
        [(table.bits, bytearray(table.frequencies.astype("<u4").tobytes()))], "bits int, frequencies binary"
    ).coalesce(1).write.parquet(f"{folder}/table")


def written_ids(docs: DataFrame, settings: TokenFileSettings) -> DataFrame:
    raw = tokenized(docs, settings)
    path = scratch_folder(docs.sparkSession)
    raw.write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(raw.schema).parquet(path)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id start n_tokens ids`` (unsigned 32-bit, little-endian) of every document in the files."""
    row = spark.read.parquet(f"{folder}/table").first()
    table = FrequencyTable(np.frombuffer(row.frequencies, "<u4").astype(np.uint64), row.bits)

    def work(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids = Payload(r["payload"], table).ids().astype("<u4")
                counts = np.array(r["doc_tokens"], np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                for a in range(0, len(counts), 500):
                    part = slice(a, a + 500)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(r["doc_ids"][part], pa.int64()),
                            pa.array(r["first"] + starts[part]),
                            pa.array(counts[part]),
                            pa.array([ids[s:e].tobytes() for s, e in zip(starts[part], ends[part])], pa.binary()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids"],
                    )

    blocks = spark.read.parquet(f"{folder}/blocks").select("first", "doc_ids", "doc_tokens", "payload")
    return arrow_map(blocks, work, "doc_id long, start long, n_tokens long, ids binary")
