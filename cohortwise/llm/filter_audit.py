"""What filters remove together, alone and in every order.

Each document has a mask of the filters that it fails. Four filters look at the text itself; the fifth
fails copies of a smaller id, which compressed tries over ranges of text prefixes find (``tries``). Masks
are counted per part and label, and every order of the filters is read off these counts: at most 32
of them for a part and label pattern.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.llm.common import written
from cohortwise.llm.tries import RANGE_BYTES, first_ids
from cohortwise.llm.words import hash_words

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
SYMBOL = np.zeros(256, bool)
SYMBOL[list(b"#$%&*|")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True


@dataclass(frozen=True)
class AuditSettings:
    """Fewest words, least share of distinct words and largest share of capitals in percent, bytes of a range."""

    words: int = 100
    distinct: int = 80
    capitals: int = 10
    range_bytes: int = RANGE_BYTES


def _sums(mask: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def text_masks(data: np.ndarray, bounds: np.ndarray, settings: AuditSettings = AuditSettings()) -> np.ndarray:
    """Bits of the filters A to D for each text; words are compared as 64-bit hashes."""
    words, at = hash_words(data, bounds, lower=False)
    n = np.diff(at)
    distinct = np.zeros(len(n), np.int64)
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        if b > a:
            found = np.sort(words[a:b])
            distinct[i] = 1 + np.count_nonzero(found[1:] != found[:-1])
    points = _sums((data & 0xC0) != 0x80, bounds)
    return (
        (n < settings.words)
        + 2 * (100 * distinct < settings.distinct * n)
        + 4 * (100 * _sums(UPPER[data], bounds) > settings.capitals * points)
        + 8 * (_sums(SYMBOL[data], bounds) > 0)
    ).astype(np.int32)


def failure_masks(docs: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """``doc_id part mask n`` of all rows; ``part`` is ``lang``, the empty string where it is null."""
    rows = docs.select("doc_id", "text", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"))
    return first_ids(rows, lambda data, bounds: text_masks(data, bounds, settings), COPY, settings.range_bytes)


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """``part mask n good toxic``: rows of each mask, those labelled of good quality and those labelled toxic."""
    known = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    kept = ["part", "mask", "n", "good", "toxic"]
    named = masks.filter("doc_id is not null")
    # rows without an id have no label; apart, they are no hot key of the join
    bare = masks.filter("doc_id is null").select("part", "mask", "n", F.lit(None).cast("int").alias("good"), F.lit(None).cast("int").alias("toxic"))
    rows = named.join(known, named["doc_id"] == known["_id"], "left").select(kept).unionByName(bare)
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"),
    )


def order_audit(counts: DataFrame) -> DataFrame:
    """Every part, order of the filters and step, from the counts of masks."""
    orders = ["".join(p) for p in permutations(LETTERS)]
    bit = lambda letter: F.lit(1 << LETTERS.index(letter))
    steps = (
        counts.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders))))
        .withColumn("step", F.explode(F.array(*(F.lit(i + 1) for i in range(len(LETTERS))))))
        .withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1)))
        .withColumn("own", F.element_at(F.create_map(*(c for x in LETTERS for c in (F.lit(x), bit(x)))), F.col("letter")))
        .withColumn("before", sum((F.when(F.instr("filter_order", x) < F.col("step"), bit(x)).otherwise(0) for x in LETTERS), F.lit(0)))
    )
    fails = F.col("mask").bitwiseAND(F.col("own")) != 0
    gone = F.col("mask").bitwiseAND(F.col("before")) != 0
    total = lambda when, what="n": F.sum(F.when(when, F.col(what)).otherwise(0))
    # a filter comes first of the filters that a document fails in 120 / (their number) orders
    share = F.floor(F.lit(len(orders)) / F.greatest(F.bit_count("mask"), F.lit(1))).cast("long")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
        F.sum(F.when(fails, F.col("n") * share).otherwise(0)).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, settings: AuditSettings = AuditSettings()) -> DataFrame:
    """What every filter removes at every place of every order, per value of ``lang``.

    ``docs`` needs ``doc_id``, ``text`` and ``lang``, ``labels`` needs ``doc_id``, ``quality`` and ``toxic``;
    other columns are ignored. A null text is an empty one, which fails filter A alone; a null ``lang`` is
    the part with the empty name. Every row counts as a document. A row without an id is no copy, makes
    none and has no label; rows that share their id and text are no copies of each other. Where several
    rows label an id, it is of good quality or toxic if any says so. An empty table has no parts.
    """
    masks = written(failure_masks(docs, settings))  # read twice: with and without ids
    return order_audit(written(mask_counts(masks, labels)))
