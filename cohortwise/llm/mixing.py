"""Mixing sources to target weights by capped water-filling.

Every source has a weight and a size (the words of its documents). The mix has a budget, shared in
proportion to the weights; a source that would be repeated more than ``epochs`` times is clamped there,
and what it leaves goes to the others in proportion, until no source is above its cap. That is the
level ``x`` at which the sum of ``min(cap, weight * x)`` is the budget: with sources in the order of
``cap / weight``, it is found from running sums.

A source then takes all its documents ``floor(target / size)`` times, and one more time the documents
that come first in a seeded order until what is left of the target is met as nearly as whole
documents can. Places in that order are numbers of 62 bits: a hash of the id, then one of the whole row and
its place in the table, so rows that share an id, or are equal, have places of their own. The cut is found from
totals of ranges of places, narrowed until few rows are left, and only those are ever ordered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.llm.common import written

BROADCAST_SOURCES = 10_000


@dataclass(frozen=True)
class MixSettings:
    """Weights repeat over the sources in code point order, a null source last."""

    weights: tuple[int, ...] = (1, 2, 3)
    epochs: int = 3
    seed: str = "mix"
    range_rows: int = 5_000


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, settings: MixSettings) -> DataFrame:
    """``source weight source_size target rows`` per source; ``sizes`` has ``source`` and ``size``.

    The windows are over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    count = len(settings.weights)
    weights = F.array(*(F.lit(w) for w in settings.weights))
    ranked = totals.withColumn("place", F.row_number().over(by_name)).withColumn(
        "weight", F.element_at(weights, F.pmod(F.col("place") - 1, F.lit(count)) + 1).cast("long")
    )
    cap = settings.epochs * F.col("source_size")
    # a source is clamped if the level reaches its cap before the budget is spent
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = (
        ranked.withColumn("cap", cap)
        .withColumn("budget", F.sum("source_size").over(everything))
        .withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("open", F.sum("weight").over(after))
        .withColumn("clamped", F.col("cap") * F.col("open") <= (F.col("budget") - F.col("spent")) * F.col("weight"))
    )
    flowing = F.sum(F.when(~F.col("clamped"), F.col("weight"))).over(everything)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("clamped"), F.col("cap"))).over(everything), F.lit(0))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise(
        (rest * F.col("weight")).cast("double") / flowing
    )
    return level.select("source", "weight", "source_size", target.alias("target"), "rows")


def draw(key: Column, seed: str) -> Column:
    """A uniform 32-bit number from the id and the seed."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")


PLACES = 62
FANOUT = 4096


def _sized(docs: DataFrame, settings: MixSettings) -> DataFrame:
    """Each row of ``docs`` as ``row``, its ``source`` and ``size``, and ``key``, its place in the seeded order."""
    number = F.col("doc_id").cast("long")
    own = docs.select(
        F.struct(*(docs[c] for c in docs.columns)).alias("row"),
        F.col("source").cast("string").alias("source"),
        word_count().alias("size"),
        draw(number, settings.seed).alias("draw"),
        F.xxhash64("text", F.monotonically_increasing_id()).alias("tie"),
    )
    low = PLACES - 32
    return own.select("row", "source", "size", F.shiftleft("draw", low).bitwiseOR(F.shiftrightunsigned("tie", 64 - low)).alias("key"))


def _hint(df: DataFrame) -> DataFrame:
    """Broadcast a table with a row per source if it is small; else leave the join to Spark."""
    small = df.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    return F.broadcast(df) if small else df


def _narrowed(sizes: DataFrame, cuts: DataFrame) -> DataFrame:
    """For each source the part of its range of places in which the running size passes the rest of its target."""
    step = F.greatest(F.lit(1).cast("long"), F.ceil((F.col("_high") - F.col("_low")) / F.lit(FANOUT)))
    inside = sizes.join(_hint(cuts), sizes.source.eqNullSafe(cuts._of) & (sizes.key >= cuts._low) & (sizes.key < cuts._high))
    inside = inside.withColumn("_step", step).withColumn("part", F.expr("(key - _low) div _step"))
    totals = inside.groupBy("_of", "part").agg(
        F.sum("size").alias("part_size"), F.count("*").alias("_rows"),
        *(F.first(c).alias(c) for c in ("_rest", "_before", "_low", "_high", "_step")),
    )
    running = Window.partitionBy("_of").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # at most FANOUT rows
    totals = totals.withColumn("_before", F.col("_before") + F.coalesce(F.sum("part_size").over(running), F.lit(0)))
    passing = totals.filter("_before <= _rest and _rest < _before + part_size")
    low = F.col("_low") + F.col("part") * F.col("_step")
    return written(
        passing.select(
            "_of", "_rest", "_before", "_rows", low.alias("_low"), F.least(low + F.col("_step"), F.col("_high")).alias("_high")
        )
    )


def mixing_plan(sized: DataFrame, settings: MixSettings) -> DataFrame:
    """One row per source: its target, whole repetitions, and where the seeded order is cut.

    A document has one more repetition if its place is below ``_cut``.
    """
    sizes = written(sized.select("source", "size", "key"))
    sources = written(
        source_targets(sizes, settings).select(
            F.col("source").alias("_of"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long").alias("_whole"),
            "rows",
        )
    ).withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
    cuts = sources.select(
        "_of", "_rest", F.lit(0).cast("long").alias("_before"), F.lit(0).cast("long").alias("_low"),
        F.lit(1 << PLACES).cast("long").alias("_high"), F.col("rows").alias("_rows"),
    )
    while True:
        cuts = _narrowed(sizes, cuts)
        most = cuts.filter("_high - _low > 1").agg(F.max("_rows")).first()[0]
        if most is None or most <= settings.range_rows:
            break
    inside = sizes.join(_hint(cuts), sizes.source.eqNullSafe(cuts._of) & (sizes.key >= cuts._low) & (sizes.key < cuts._high))
    first = Window.partitionBy("_of").orderBy("key").rangeBetween(Window.unboundedPreceding, -1)
    same = Window.partitionBy("_of", "key")
    # rows at the same place, should two ever share one, are taken together
    nearest = inside.withColumn("so_far", F.col("_before") + F.coalesce(F.sum("size").over(first), F.lit(0))).withColumn(
        "together", F.sum("size").over(same)
    )
    kept = nearest.filter("2 * so_far + together <= 2 * _rest")
    limits = kept.groupBy(F.col("_of").alias("limit_of")).agg((F.max("key") + 1).alias("_limit"))
    whole = sources.join(cuts.select(F.col("_of").alias("cut_of"), "_low"), sources._of.eqNullSafe(F.col("cut_of")), "left")
    whole = whole.join(limits, whole._of.eqNullSafe(limits.limit_of), "left")
    return written(
        whole.select("_of", "_source_size", "_target", "_whole", F.coalesce("_limit", "_low", F.lit(0).cast("long")).alias("_cut"))
    )


def repetitions(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """``row`` (all columns of ``docs``), ``size source_size target copies``; one row per row of ``docs``.

    ``docs`` needs ``doc_id``, ``text`` and ``source``; other columns may have any name. A null text has
    size 0 and is taken like any other of its source; a null source is a source. A source without
    words has target 0 and is not repeated. Rows that repeat an id, have none or are equal are rows of their own,
    each with its own place in the order. ``docs`` is read twice and must give its rows in the same order, as files do.
    An empty table gives an empty one.
    """
    sized = _sized(docs, settings)
    plan = mixing_plan(sized, settings)
    rows = sized.join(_hint(plan), sized.source.eqNullSafe(plan._of))
    copies = F.col("_whole") + (F.col("key") < F.col("_cut")).cast("long")
    return rows.select(
        "row", "size", F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), copies.alias("copies")
    )


def mixed(docs: DataFrame, settings: MixSettings = MixSettings()) -> DataFrame:
    """The mix: every row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    taken = repetitions(docs, settings).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
