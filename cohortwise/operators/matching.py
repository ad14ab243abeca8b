"""1:1 nearest matching without replacement on one score.

Comparison rows choose in a fixed order, the one with the farthest nearest reference first;
each takes the nearest reference not yet used, if it is within the caliper. Since every
reference would prefer the earliest chooser, the same pairs come out when all comparisons
propose at once, references keep their earliest chooser and turned-down comparisons move on
to their next nearest reference. That form needs no global sequence:

* rows with equal scores are one *cell* with a number of units, so a score shared by a third
  of the rows is a single record;
* cells are cut into blocks, contiguous in score and similar in size; proposals inside a block
  are settled by one task, a proposal that has to look beyond its block moves to the next one;
* rounds repeat until no proposal moves. The state is checkpointed between rounds.

No candidate list is built and no partner is cut off: a comparison stops at the caliper only.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, rate
from cohortwise.functions.pvalues import mcnemar_exact
from cohortwise.operators.ordering import (
    assign_range,
    hash_order_positions,
    range_edges,
    running_totals,
)
from cohortwise.session import cut_lineage
from cohortwise.spec import AnalysisError

BLOCK_CELLS = 50_000
LEAST_CELLS = 1_000
UNIT_CHUNK = 4096
CANDIDATES = 500
RANGE_REFERENCES = 50_000
COMPARISON, REFERENCE = "comparison", "reference"

PROPOSAL, HOLD = 0, 1
STATE_SCHEMA = (
    "block int, kind int, x double, hardness double, units bigint, lo double, hi double, "
    "reference double"
)


def score_cells(rows: DataFrame, code: str, logit: str) -> DataFrame:
    """Per distinct score: how many comparisons want and how many references offer."""
    wanted = F.sum(col(code)).cast("bigint")
    return rows.groupBy(col(logit).alias("x")).agg(
        wanted.alias("demand"), (F.count("*") - wanted).alias("supply")
    )


def nearest_supply(cells: DataFrame, block: str = "block") -> DataFrame:
    """Add the distance from each cell to the nearest cell with references.

    Inside a block a window looks both ways; across blocks only the first and last supply
    score of each block count (one row per block, at most ``MAX_RANGES`` blocks).
    """
    offered = F.when(F.col("supply") > 0, F.col("x"))
    edges = cells.groupBy(block).agg(F.min(offered).alias("first"), F.max(offered).alias("last"))
    one = Window.partitionBy(F.lit(0)).orderBy(block)
    before = one.rowsBetween(Window.unboundedPreceding, -1)
    after = one.rowsBetween(1, Window.unboundedFollowing)
    edges = edges.select(
        block,
        F.max("last").over(before).alias("__left"),
        F.min("first").over(after).alias("__right"),
    )
    near = Window.partitionBy(block).orderBy("x")
    left = F.last(offered, ignorenulls=True).over(near.rowsBetween(Window.unboundedPreceding, 0))
    right = F.first(offered, ignorenulls=True).over(near.rowsBetween(0, Window.unboundedFollowing))
    looked = cells.select("*", left.alias("__l"), right.alias("__r")).join(F.broadcast(edges), block)
    to_left = F.col("x") - F.coalesce("__l", "__left")
    to_right = F.coalesce("__r", "__right") - F.col("x")
    return looked.select(
        *cells.columns, F.least(to_left, to_right).alias("hardness")
    )


class _Room:
    """The references of one block in order of score, and how many units each still takes.

    ``up[j]`` leads to the next reference from ``j`` on with room, ``down[j]`` to the last one before ``j``;
    paths are shortened as they are walked, so a full stretch is passed over in a step or two.
    """

    def __init__(self, scores: np.ndarray, capacity: np.ndarray):
        self.scores = scores
        self.left = capacity.tolist()
        self.up, self.down = list(range(len(scores) + 1)), list(range(len(scores) + 1))
        for j in np.flatnonzero(capacity <= 0).tolist():
            self._close(j)

    def _close(self, j: int) -> None:
        self.up[j] = j + 1
        self.down[j + 1] = j

    @staticmethod
    def _follow(step: list[int], j: int) -> int:
        while step[j] != j:
            step[j] = step[step[j]]
            j = step[j]
        return j

    def last_below(self, lo: float) -> int | None:
        """The highest reference score up to ``lo`` with room."""
        j = self._follow(self.down, int(np.searchsorted(self.scores, lo, side="right")))
        return j - 1 if j else None

    def first_above(self, hi: float) -> int | None:
        """The lowest reference score from ``hi`` on with room."""
        j = self._follow(self.up, int(np.searchsorted(self.scores, hi, side="left")))
        return j if j < len(self.scores) else None

    def take(self, j: int, units: int) -> int:
        """Give up to ``units`` of reference ``j``; returns how many."""
        taken = min(units, self.left[j])
        self.left[j] -= taken
        if not self.left[j]:
            self._close(j)
        return taken


def _down(value: float) -> float:
    return float(np.nextafter(value, -np.inf))


def _up(value: float) -> float:
    return float(np.nextafter(value, np.inf))


def _settle(number: int, state: pd.DataFrame, supply: pd.DataFrame, radius, edges, closed):
    """One round of one block: settle proposals, pass on those that must look elsewhere.

    What is kept from earlier rounds is proposed again, from the kept reference on, together with what came in. In
    the order of choosers each takes the nearest reference with room, so nothing given is taken back within a round.
    References up to ``lo`` and from ``hi`` on have not yet turned the proposal down; the nearer one is asked first,
    the lower one on ties. ``closed`` tells for blocks without room the order of their weakest kept proposal, so
    that they can be passed over.
    """
    bounds = [-math.inf, *edges, math.inf]
    supply = supply.sort_values("score")
    room = _Room(supply["score"].to_numpy(), supply["supply"].to_numpy())
    held = (state["kind"] == HOLD).to_numpy()
    x, lo, hi, reference = (state[c].to_numpy(dtype=float).copy() for c in ("x", "lo", "hi", "reference"))
    hi = np.where(np.isnan(hi), np.nextafter(x, np.inf), hi)
    below = held & (reference <= x)
    lo, hi = np.where(below, reference, lo), np.where(held & ~below, reference, hi)
    hardness = state["hardness"].to_numpy(dtype=float)
    order = np.lexsort((np.minimum(x - lo, hi - x), x, -hardness))
    queue = zip(*(c[order].tolist() for c in (x, hardness, state["units"].to_numpy(), lo, hi)))

    def passes_over(k: int, chooser: float, rank: float) -> bool:
        if k not in closed:
            return False
        h, other = closed[k]
        return (h, -other) >= (rank, -chooser)

    def home(value: float) -> int:
        return int(np.searchsorted(edges, value, side="right"))

    out = []
    for at, rank, units, low, high in queue:
        while units:
            left = right = None
            k = home(low)
            while low > -math.inf:
                if k == number:
                    left = room.last_below(low)
                    if left is not None:
                        low = float(room.scores[left])
                        break
                elif not passes_over(k, at, rank):
                    break
                low, k = _down(bounds[k]), k - 1
            k = home(high)
            while high < math.inf:
                if k == number:
                    right = room.first_above(high)
                    if right is not None:
                        high = float(room.scores[right])
                        break
                elif not passes_over(k, at, rank):
                    break
                high, k = bounds[k + 1], k + 1
            to_left, to_right = at - low, high - at
            if min(to_left, to_right) > radius:
                break
            asked = left if to_left <= to_right else right
            if asked is None:
                target = home(low) if to_left <= to_right else home(high)
                out.append((target, PROPOSAL, at, rank, units, low, high, None))
                break
            taken = room.take(asked, units)
            units -= taken
            score = float(room.scores[asked])
            if to_left <= to_right:
                low = _down(low)
            else:
                high = _up(high)
            out.append((number, HOLD, at, rank, taken, low, high, score))
    names = ["block", "kind", "x", "hardness", "units", "lo", "hi", "reference"]
    return pd.DataFrame(out, columns=names).astype({"reference": "float64"})


def cells_per_block(cells: int, cores: int) -> int:
    """Two blocks for every core, none larger than ``BLOCK_CELLS`` or smaller than ``LEAST_CELLS``."""
    return min(BLOCK_CELLS, max(LEAST_CELLS, -(-cells // (2 * cores))))


def match_cells(cells: DataFrame, radius: float, per_block: int | None = None) -> DataFrame:
    """How many units of each comparison score go to which reference score."""
    n = cells.count()
    per_block = per_block or cells_per_block(n, cells.sparkSession.sparkContext.defaultParallelism)
    edges = range_edges(cells, "x", n, per_block)
    ranged = assign_range(cells, "x", edges, "block")
    supply = ranged.filter("supply > 0").select(
        F.col("block").alias("home"), F.col("x").alias("score"), "supply"
    ).persist()
    choosers = nearest_supply(ranged).filter((F.col("demand") > 0) & (F.col("hardness") <= radius))
    nothing = F.lit(None).cast("double")
    state = choosers.select(
        "block",
        F.lit(PROPOSAL).alias("kind"),
        "x",
        "hardness",
        F.col("demand").alias("units"),
        F.col("x").alias("lo"),
        nothing.alias("hi"),
        nothing.alias("reference"),
    )
    closed: dict[int, tuple[float, float]] = {}
    while True:
        known = closed

        def settle(key, found: pd.DataFrame, offered: pd.DataFrame) -> pd.DataFrame:
            return _settle(int(key[0]), found, offered, radius, edges, known)

        state = cut_lineage(
            state.groupBy("block").cogroup(supply.groupBy("home")).applyInPandas(settle, STATE_SCHEMA)
        )
        if state.filter(F.col("kind") == PROPOSAL).isEmpty():
            break
        closed = _closed_blocks(state, supply)
    return state.filter(F.col("kind") == HOLD).select(
        "x", "reference", "units", F.abs(F.col("x") - F.col("reference")).alias("distance")
    )


def _closed_blocks(state: DataFrame, supply: DataFrame) -> dict[int, tuple[float, float]]:
    """Blocks without room and the order of their weakest kept proposal; one row per block."""
    kept = state.filter(F.col("kind") == HOLD).groupBy("block").agg(
        F.sum("units").alias("used"),
        F.min(F.struct("hardness", (-F.col("x")).alias("minus_x"))).alias("weakest"),
    )
    offered = supply.groupBy(F.col("home").alias("block")).agg(F.sum("supply").alias("supply"))
    full = kept.join(offered, "block").filter(F.col("used") >= F.col("supply"))
    return {r.block: (r.weakest.hardness, -r.weakest.minus_x) for r in full.collect()}


def allot_units(flows: DataFrame) -> DataFrame:
    """One row per pair: the place of its comparison and of its reference inside their cells."""
    placed = running_totals(flows, "reference", {"x_start": "units"}, ["x"])
    placed = running_totals(placed, "x", {"reference_start": "units"}, ["reference"])
    # A large flow is unrolled in two steps, so that no task unrolls all of it.
    pieces = placed.select(
        "*", F.explode(F.sequence(F.lit(0), F.col("units") - 1, F.lit(UNIT_CHUNK))).alias("__from")
    ).repartition("x", "reference", "__from")
    length = F.least(F.lit(UNIT_CHUNK).cast("bigint"), F.col("units") - F.col("__from"))
    units = pieces.withColumn("__step", F.explode(F.sequence(F.lit(0), length - 1)))
    offset = F.col("__from") + F.col("__step")
    return units.select(
        "x",
        (F.col("x_start") + offset).alias("x_place"),
        "reference",
        (F.col("reference_start") + offset).alias("reference_place"),
        "distance",
    )


def match_rows(
    rows: DataFrame, code: str, logit: str, key: str, radius: float, per_block: int | None = None
) -> DataFrame:
    """Matched pairs: ``comparison`` and ``reference`` records and their distance.

    Within a score the rows are taken in the order of their hashed key.
    """
    names = rows.columns
    hashed = rows.withColumn("__digest", F.unhex(F.md5(col(key).cast("string"))))
    flows = match_cells(score_cells(rows, code, logit).persist(), radius, per_block)
    units = allot_units(flows)
    places = hash_order_positions(hashed, "__digest", "__place", [logit, code], digits=1)
    record = F.struct(*[col(n) for n in names])
    comparisons = places.filter(col(code) == 1).select(
        col(logit).alias("x"), F.col("__place").alias("x_place"), record.alias(COMPARISON)
    )
    references = places.filter(col(code) == 0).select(
        col(logit).alias("reference"),
        F.col("__place").alias("reference_place"),
        record.alias("__reference"),
    )
    # Spark takes the unrolled units for as few as the flows they come from and would broadcast them: every join is merged.
    return (
        units.hint("merge").join(comparisons.hint("merge"), ["x", "x_place"])
        .hint("merge").join(references.hint("merge"), ["reference", "reference_place"])
        .select(COMPARISON, F.col("__reference").alias(REFERENCE), "distance")
    )


def matched_table(pairs: DataFrame, key: str) -> DataFrame:
    """Two rows per pair with all columns, the pair and the role."""
    names = pairs.schema[COMPARISON].dataType.names

    def member(role: str) -> Column:
        return F.struct(
            *[F.col(role)[n].alias(n) for n in names],
            F.col(role)[key].alias("source_index"),
            F.col(COMPARISON)[key].alias("pair_id"),
            F.lit(role).alias("matched_role"),
            F.col("distance").alias("match_distance"),
        )

    return pairs.select(F.inline(F.array(member(COMPARISON), member(REFERENCE))))


def nearest_references(
    rows: DataFrame, code: str, logit: str, key: str, count: int = CANDIDATES, per_range: int = RANGE_REFERENCES
) -> DataFrame:
    """For every comparison score its ``count`` nearest references, a top-k report.

    References are numbered along the score and cut into ranges; each range borrows ``count`` references from either
    neighbour. A comparison score lies between two places, and its nearest references are read off both sides of that
    place by two pointers, the lower side first on ties. What is shuffled are the rows and the borrowed references.
    """
    cells = score_cells(rows, code, logit).persist()
    ranked = running_totals(cells, "x", {"below": "supply"})
    total = cells.agg(F.sum("supply")).first()[0] or 0
    size = max(per_range, count)
    numbered = hash_order_positions(
        rows.filter(col(code) == 0).withColumn("__digest", F.unhex(F.md5(col(key).cast("string")))),
        "__digest", "__place", [logit], digits=1,
    )
    references = numbered.join(
        ranked.filter("supply > 0").select(F.col("x").alias("__x"), "below"), col(logit) == F.col("__x")
    ).select(
        (F.col("below") + F.col("__place")).alias("place"), col(logit).cast("double").alias("score"), col(key).alias("id"),
    )
    own = F.floor(F.col("place") / size)
    inside = F.col("place") - own * size
    parts = [
        references.withColumn("range", own),
        references.filter(inside < count).withColumn("range", own - 1),
        references.filter(inside >= size - count).withColumn("range", own + 1),
    ]
    kind = dict(references.dtypes)["id"]
    choosers = ranked.filter("demand > 0").select(
        F.col("below").alias("place"), F.col("x").cast("double").alias("score"), F.lit(None).cast(kind).alias("id"),
        F.floor(F.least("below", F.lit(max(total - 1, 0))) / size).alias("range"),
    )
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).withColumn("chooser", F.lit(0))
    whole = whole.unionByName(choosers.withColumn("chooser", F.lit(1)))
    dealt = whole.repartition("range").sortWithinPartitions("range", "chooser", "place")
    schema = f"x double, rank int, reference_id {kind}, reference double, distance double"
    return dealt.select("range", "chooser", "place", "score", "id").mapInArrow(_two_pointers(count), schema)


def _two_pointers(count: int):
    """Reads ranges, the references of each before its choosers; holds one range of references."""

    def nearest(x: float, below: int, first: int, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the nearest references lie, and their ranks from 0 on."""
        at = below - first
        lower = np.arange(at - 1, max(at - count, 0) - 1, -1)
        upper = np.arange(at, min(at + count, len(scores)))
        down, up = x - scores[lower], scores[upper] - x
        places = np.concatenate([lower, upper])
        ranks = np.concatenate(
            [np.arange(len(lower)) + np.searchsorted(up, down, "left"), np.arange(len(upper)) + np.searchsorted(down, up, "right")]
        )
        kept = np.flatnonzero(ranks < count)
        order = kept[np.argsort(ranks[kept])]
        return places[order], ranks[order]

    def work(batches):
        names = ["x", "rank", "reference_id", "reference", "distance"]
        now, held, scores, ids, first = None, [], None, None, 0
        for batch in batches:
            ranges, kinds, places, values = (batch.column(c).to_numpy() for c in ("range", "chooser", "place", "score"))
            edges = np.flatnonzero(np.append(True, (ranges[1:] != ranges[:-1]) | (kinds[1:] != kinds[:-1]))) if len(ranges) else []
            for a, b in zip(edges, [*edges[1:], len(ranges)]):
                if ranges[a] != now:
                    now, held, scores = ranges[a], [], None
                if not kinds[a]:
                    held.append((int(places[a]), values[a:b], batch.column("id").slice(a, b - a)))
                    continue
                if scores is None:
                    if not held:
                        continue  # there is no reference at all
                    first, scores = held[0][0], np.concatenate([h[1] for h in held])
                    ids = pa.concat_arrays([h[2] for h in held])
                for i in range(a, b):
                    found, ranks = nearest(float(values[i]), int(places[i]), first, scores)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(len(found), values[i])), pa.array((ranks + 1).astype(np.int32)),
                            ids.take(pa.array(found)), pa.array(scores[found]), pa.array(np.abs(scores[found] - values[i])),
                        ],
                        names=names,
                    )

    return work


def pair_outcomes(matched: DataFrame, outcome: str) -> DataFrame:
    """One row per complete pair with the outcome of both members."""

    def of(role: str) -> Column:
        return F.max(F.when(F.col("matched_role") == role, col(outcome).cast("int"))).alias(role)

    return matched.groupBy("pair_id").agg(of(COMPARISON), of(REFERENCE)).na.drop()


def mcnemar(pairs: DataFrame) -> DataFrame:
    """One row: discordant pairs and the exact test on them."""
    comparison_only = F.count_if((F.col(COMPARISON) == 1) & (F.col(REFERENCE) == 0))
    reference_only = F.count_if((F.col(COMPARISON) == 0) & (F.col(REFERENCE) == 1))
    counts = pairs.agg(
        comparison_only.alias("comparison_only_positive_pairs"),
        reference_only.alias("reference_only_positive_pairs"),
    )
    b, c = F.col("comparison_only_positive_pairs"), F.col("reference_only_positive_pairs")
    return counts.select(
        b, c,
        F.least(b, c).cast("double").alias("mcnemar_statistic"),
        mcnemar_exact(b, c).alias("mcnemar_p_value"),
    )


def matched_rates(matched: DataFrame, outcome: str) -> DataFrame:
    """One row: outcome rate per role and their difference."""

    def of(role: str) -> Column:
        return F.avg(F.when(F.col("matched_role") == role, col(outcome).cast("double")))

    return matched.agg(
        of(REFERENCE).alias("reference_rate"),
        of(COMPARISON).alias("comparison_rate"),
        (of(COMPARISON) - of(REFERENCE)).alias("matched_rate_difference"),
    )


def matching_report(matched: DataFrame, before: dict, support: dict) -> DataFrame:
    """One row: pairs, group sizes before and inside the support, retention and distance."""
    mine = F.col("matched_role") == COMPARISON
    pairs = F.count_if(mine)
    return matched.agg(
        pairs.alias("matched_pairs"),
        F.lit(before["comparison_n"]).cast("bigint").alias("comparison_before_common_support"),
        F.lit(before["reference_n"]).cast("bigint").alias("reference_before_common_support"),
        F.lit(support["comparison_n"]).cast("bigint").alias("comparison_in_common_support"),
        F.lit(support["reference_n"]).cast("bigint").alias("reference_in_common_support"),
        rate(pairs, F.lit(before["comparison_n"])).alias("comparison_retention_rate"),
        F.lit(support["lower"]).alias("common_support_lower"),
        F.lit(support["upper"]).alias("common_support_upper"),
        F.lit(support["caliper"]).alias("caliper"),
        F.avg(F.when(mine, F.col("match_distance"))).alias("mean_match_distance"),
    )


def require_pairs(count: int) -> None:
    if count < 2:
        raise AnalysisError("fewer than two pairs lie within the caliper")
