"""Exact linear-interpolation quantiles of columns of any size.

The built-in exact ``percentile`` keeps every distinct value in one task. It is used up to ``DIRECT_ROWS``
rows, and for any number of rows with at most a ``REPEATED``-th of that in distinct values. Beyond that each wanted rank is first bracketed with the bounded
``percentile_approx`` sketch, the rows below and inside the bracket are counted, and the
bracket is narrowed until the values inside are few; only those are ordered. Every pass is a
scan with a small aggregate, nothing is shuffled by value except the last few values.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.columns import col

DIRECT_ROWS = 2_000_000
REPEATED = 100
INSIDE_ROWS = 1_000_000
ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    columns: Iterable[str],
    probabilities: Iterable[float],
    direct_rows: int = DIRECT_ROWS,
    inside_rows: int = INSIDE_ROWS,
    accuracy: int = ACCURACY,
) -> dict[str, list[float | None]]:
    """Quantiles per column, nulls ignored; ``None`` entries for a column without values."""
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    values = {c: col(c).cast("double") for c in columns}
    measures = [m for v in values.values() for m in (F.count(v), F.approx_count_distinct(v))]
    counts = df.agg(*[m.alias(f"n{i}") for i, m in enumerate(measures)]).first()
    sizes, distinct = (dict(zip(columns, counts[i::2], strict=True)) for i in (0, 1))
    whole = {c for c in columns if sizes[c] <= direct_rows or distinct[c] <= direct_rows // REPEATED}
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}

    small = [c for c in columns if c in whole and sizes[c] > 0]
    if small:
        row = df.agg(*[F.percentile(values[c], probabilities) for c in small]).first()
        for c, found in zip(small, row, strict=True):
            result[c] = [float(v) for v in found]

    wanted = {
        (c, rank): _Rank(c, rank, sizes[c])
        for c in columns
        if c not in whole
        for p in probabilities
        for rank in _neighbours(sizes[c], p)
    }
    searches = list(wanted.values())
    while any(s.open and s.inside > inside_rows for s in searches):
        _narrow(df, values, [s for s in searches if s.open and s.inside > inside_rows], accuracy)
    _read_values(df, values, [s for s in searches if s.open])
    for c in columns:
        if c not in whole:
            result[c] = []
            for p in probabilities:
                first, last = _neighbours(sizes[c], p)
                a, b = wanted[c, first].value, wanted[c, last].value
                result[c].append(_between(a, b, (sizes[c] - 1) * p, first, last))
    return result


def _between(a: float, b: float, position: float, first: int, last: int) -> float:
    """Linear interpolation as the built-in ``percentile`` does it, infinite ends included."""
    if first == last or a == b or (math.isnan(a) and math.isnan(b)):
        return a
    return (last - position) * a + (position - first) * b


def _neighbours(n: int, p: float) -> tuple[int, int]:
    position = (n - 1) * p
    return math.floor(position), math.ceil(position)


class _Rank:
    """The search for one order statistic: it lies strictly between ``low`` and ``high``."""

    def __init__(self, column: str, rank: int, n: int):
        self.column, self.rank = column, rank
        self.low, self.high = -math.inf, math.inf
        self.below, self.inside = 0, n
        self.value: float | None = None

    @property
    def open(self) -> bool:
        return self.value is None

    def within(self, value):
        # Infinite data values must stay reachable while the bounds are still infinite.
        above = F.lit(True) if self.low == -math.inf else value > self.low
        under = F.lit(True) if self.high == math.inf else value < self.high
        return above & under

    def update(self, low, high, under_low, at_low, under_high, at_high) -> None:
        r = self.rank
        if under_low <= r < under_low + at_low:
            self.value = low
        elif under_high <= r < under_high + at_high:
            self.value = high
        elif r < under_low:
            self.high, self.inside = low, under_low - self.below
        elif r < under_high:
            self.low, self.high = low, high
            self.below, self.inside = under_low + at_low, under_high - under_low - at_low
        else:
            self.inside -= under_high + at_high - self.below
            self.low, self.below = high, under_high + at_high


def _by_bracket(searches: list[_Rank]) -> dict[tuple, list[_Rank]]:
    """Searches that look at the same values; at first all of a column."""
    found: dict[tuple, list[_Rank]] = {}
    for s in searches:
        found.setdefault((s.column, s.low, s.high), []).append(s)
    return found


def _narrow(df: DataFrame, values: dict, searches: list[_Rank], accuracy: int) -> None:
    """Sketch the values inside each bracket once, then count exactly around the proposed bounds.

    The bounds themselves are counted apart, so one value holding a third of the rows is
    either the answer or falls out of the bracket. Bounds that searches share are counted once.
    """
    sketches, brackets = [], list(_by_bracket(searches).values())
    margin = 2.0 / accuracy
    for held in brackets:
        value, shares = values[held[0].column], []
        for s in held:
            at = (s.rank - s.below) / max(s.inside - 1, 1)
            shares += [max(0.0, at - margin), min(1.0, at + margin)]
        sketches.append(F.percentile_approx(F.when(held[0].within(value), value), shares, accuracy))
    bounds: dict[_Rank, tuple[float, float]] = {}
    for held, found in zip(brackets, df.agg(*sketches).first(), strict=True):
        bounds |= zip(held, zip(found[::2], found[1::2]))
    edges = list(dict.fromkeys((s.column, edge) for s in searches for edge in bounds[s]))
    counts = []
    for column, edge in edges:
        counts += [F.count_if(values[column] < edge), F.count_if(values[column] == edge)]
    row = df.agg(*counts).first()
    counted = {edge: (row[2 * i], row[2 * i + 1]) for i, edge in enumerate(edges)}
    for s in searches:
        low, high = bounds[s]
        s.update(float(low), float(high), *counted[s.column, low], *counted[s.column, high])


def _read_values(df: DataFrame, values: dict, searches: list[_Rank]) -> None:
    """Order the few values inside each bracket and read off the wanted ranks."""
    if not searches:
        return
    brackets = list(_by_bracket(searches).values())
    inside = [held[0].within(values[held[0].column]) & values[held[0].column].isNotNull() for held in brackets]
    entries = [
        F.when(kept, F.struct(F.lit(i).alias("i"), values[held[0].column].alias("v")))
        for i, (held, kept) in enumerate(zip(brackets, inside, strict=True))
    ]
    near = F.lit(False)
    for kept in inside:
        near = near | kept
    counted = (
        df.filter(near)  # most rows lie in no bracket
        .select(F.explode(F.array(*entries)).alias("e"))
        .filter(F.col("e").isNotNull())
        .groupBy("e.i", "e.v")
        .agg(F.count("*").alias("n"))
    )
    # A partition of this window holds one bracket: at most ``inside_rows`` rows.
    upto = F.sum("n").over(Window.partitionBy("i").orderBy("v"))
    spans = counted.withColumn("upto", upto)
    hit, ranks = F.lit(False), []
    for i, held in enumerate(brackets):
        for s in held:
            rank = s.rank - s.below
            ranks.append((i, rank, s))
            hit = hit | (
                (F.col("i") == i) & (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
            )
    found = spans.filter(hit).collect()
    for i, rank, s in ranks:
        s.value = next(float(r.v) for r in found if r.i == i and r.upto - r.n <= rank < r.upto)
