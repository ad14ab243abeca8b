"""Query of operator 3: documents in order, their edited texts, and fingerprints of both."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import arrow_map, documents
from cohortwise.llm.phrases import fingerprints, likeness

CHUNK = 1 << 20
RANGES = 16
HOT = 4
MOST_RANGES = 100_000  # one broadcast row each; the result does not depend on the number
OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def in_order(docs: DataFrame) -> DataFrame:
    """``bucket borrowed doc_id text``: ranges of ids, each with the first row of the next one at its end.

    Rows are ordered by id (none first), then by a hash of the text. Only one row a range is copied. An id that
    many rows share is cut into several ranges by that hash.
    """
    # several small ranges a partition, so that hashing them to partitions comes out even
    partitions = max(1, docs.rdd.getNumPartitions())
    buckets = min(RANGES * partitions, MOST_RANGES)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("double"), F.lit(float("-inf"))).alias("place"),
    )
    ids = rows.select("place")
    known = ids.filter(F.col("place") > float("-inf"))
    total = ids.count()
    share = max(1.0, total / buckets)
    cuts = known.approxQuantile("place", [i / buckets for i in range(1, buckets)], max(0.2 / buckets, 1e-5))
    # an id with many rows, or none, is a range of its own; there are fewer of them than ranges
    hot = [r.place for r in ids.groupBy("place").count().filter(F.col("count") > HOT * share).collect()]
    least = known.agg(F.min("place")).first()[0]
    cuts += [c for h in hot for c in ((h, math.nextafter(h, math.inf)) if h > float("-inf") else (least,))]
    splits = [float("-inf"), *sorted({c for c in cuts if c is not None}), float("inf")]
    if len(splits) < 3:
        splits = [float("-inf"), 0.0, float("inf")]
    dealt = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(rows)
    dealt = dealt.withColumn("bucket", F.col("bucket").cast("int")).withColumn("tie", F.xxhash64("text"))
    # such a range is cut by the hash of the text, in which its rows are ordered
    parts = F.ceil(F.col("rows") / F.lit(share)).cast("int")
    sizes = dealt.filter(F.col("place").isin(hot) if hot else F.lit(False)).groupBy(F.col("place").alias("hot")).agg(F.count("*").alias("rows"))
    dealt = dealt.join(F.broadcast(sizes.withColumn("parts", parts)), F.col("place") == F.col("hot"), "left")  # fewer rows than ranges
    part = F.floor((F.col("tie").cast("double") / float(1 << 64) + 0.5) * F.col("parts")).cast("int")
    part = F.coalesce(F.least(part, F.col("parts") - 1), F.lit(0))
    dealt = dealt.withColumn("bucket", F.col("bucket").cast("long") * (1 << 31) + part).select("bucket", "doc_id", "tie", "text")
    heads = dealt.groupBy("bucket").agg(F.min(F.struct(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), "tie")).alias("head"))
    # one row per range: who borrows it is the range before, the last one for the first
    every = Window.orderBy("bucket")
    heads = heads.select(
        F.col("bucket").alias("of"),
        F.col("head")["tie"].alias("head_tie"),
        F.col("head")["col1"].alias("head_id"),
        F.coalesce(F.lag("bucket").over(every), F.max("bucket").over(Window.partitionBy())).alias("by"),
    )
    own = F.array(F.struct(F.col("bucket"), F.lit(False).alias("borrowed")))
    lent = F.array(F.struct(F.col("by").alias("bucket"), F.lit(True).alias("borrowed")))
    is_head = (F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))) == F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    return (
        dealt.join(F.broadcast(heads), dealt.bucket == heads.of)
        .withColumn("to", F.explode(F.when(is_head, F.concat(own, lent)).otherwise(own)))
        .select("to.bucket", "to.borrowed", "doc_id", "tie", "text")
        .repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "borrowed", "doc_id", "tie")
        .select("bucket", "borrowed", "doc_id", "text")
    )


def compared(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are; one row per row.

    A null text is empty. The next document is the next row by id, then by a hash of the text; rows that
    repeat an id follow each other. Rows without an id come first. A single row is its own next one; an
    empty table gives an empty one. Other columns are ignored.
    """

    def rows_of(keys, texts):
        """All but the last row, which is only the next one of the row before."""
        edited = []
        for own, after in zip(texts[:-1], texts[1:]):
            half = len(own) // 2
            edited.append((own[: len(own) - half] + after[:half]).encode())
        plain = fingerprints([t.encode() for t in texts])
        other = fingerprints(edited)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(keys[:-1], pa.int64()),
                pa.array([len(t) for t in texts[:-1]], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in edited]),
                pa.array([f.tobytes().hex() for f in plain[:-1]]),
                pa.array([f.tobytes().hex() for f in other]),
                pa.array(likeness(plain[:-1], other)),
                pa.array(likeness(plain[:-1], plain[1:])),
            ],
            names=[c.split()[0] for c in OUT.split(", ")],
        )

    def work(batches):
        bucket, keys, texts, size = None, [], [], 0
        done = False  # the borrowed row of the range has been met
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "borrowed", "doc_id", "text"))
            for at, borrowed, key, text in zip(*columns):
                if at != bucket:
                    bucket, keys, texts, size, done = at, [], [], 0, False
                if done:
                    continue
                keys.append(key)
                texts.append(text)
                size += len(text)
                done = borrowed
                if len(keys) > 1 and (borrowed or size >= CHUNK):
                    yield rows_of(keys, texts)
                    keys, texts, size = keys[-1:], texts[-1:], len(texts[-1])

    return arrow_map(in_order(docs), work, OUT)


def op3_locally_consistent(spark: SparkSession, folder: str) -> DataFrame:
    return compared(documents(spark, folder))


QUERIES = {"op3_locally_consistent": op3_locally_consistent}
ORACLES: dict[str, str] = {}
