"""Global orders without a global window.

A window without partitions, or one partitioned by a class that holds a third of the rows,
puts that many rows into one task. Two ways around it live here:

* ``running_totals`` - cumulative sums along an ordered key: the key is cut into ranges of
  similar size, totals per range are accumulated first and rows only inside their range;
* ``hash_cut_points`` - the exact key at which a share of a class is reached when rows are
  ordered by a hash, found by counting hash prefixes. A split is then a plain filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.spec import AnalysisError

WINDOW_ROWS = 200_000
SKETCH = 200_000  # accuracy of the sketch that proposes range edges
PREFIX = 3  # hex digits counted per step: at most 4096 counts per class


def range_edges(df: DataFrame, key: str, rows: int, per_range: int = WINDOW_ROWS) -> list[float]:
    """Inner edges that cut ``key`` into ranges of about ``per_range`` rows."""
    ranges = -(-rows // per_range)
    if ranges <= 1:
        return []
    cuts = [i / ranges for i in range(1, ranges)]
    value = col(key).cast("double")
    value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
    found = df.agg(F.percentile_approx(value, cuts, max(10, min(4 * ranges, SKETCH)))).first()[0]
    return sorted(set(found or []))


def assign_range(df: DataFrame, key: str, edges: Sequence[float], out: str) -> DataFrame:
    """Add the number of the range that holds ``key``, in the order of Spark: null first, NaN last."""
    if not edges:
        return df.withColumn(out, F.lit(0))
    bounds = [-float("inf"), *edges, float("inf")]
    value = col(key).cast("double")
    plain = df.withColumn("__value", F.when(value.isNull() | F.isnan(value), 0.0).otherwise(value))
    number = Bucketizer(splits=bounds, inputCol="__value", outputCol=out).transform(plain).drop("__value")
    place = F.when(value.isNull(), -1).when(F.isnan(value), len(bounds)).otherwise(F.col(out).cast("int"))
    return number.withColumn(out, place)


def running_totals(
    rows: DataFrame,
    key: str,
    sums: dict[str, str],
    groups: Iterable[str] = (),
    per_range: int = WINDOW_ROWS,
) -> DataFrame:
    """Add ``before`` totals: for each ``out: column`` the sum over smaller keys.

    ``rows`` must hold each key once per group; callers aggregate first, so a key shared by
    many raw rows is a single row here. A null group is a group, a null key comes before all
    others and NaN after them, whatever the number of rows.
    """
    groups = list(groups)
    total = rows.count()
    if total <= per_range:
        window = Window.partitionBy(*groups, F.lit(0)).orderBy(col(key))
        return rows.select(
            "*", *[(F.sum(c).over(window) - F.col(c)).alias(out) for out, c in sums.items()]
        )
    edges = range_edges(rows, key, total, per_range)
    ranged = assign_range(rows, key, edges, "__range")
    steps = ranged.groupBy(*groups, "__range").agg(
        *[F.sum(c).alias(f"__step_{out}") for out, c in sums.items()]
    )
    across = Window.partitionBy(*groups, F.lit(0)).orderBy("__range")
    named = [F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)]
    steps = steps.select(
        *named,
        F.col("__range").alias("__of"),
        *[
            (F.sum(f"__step_{out}").over(across) - F.col(f"__step_{out}")).alias(f"__base_{out}")
            for out in sums
        ],
    )
    inside = Window.partitionBy(*groups, "__range").orderBy(col(key))
    same = ranged["__range"] == steps["__of"]
    for i, g in enumerate(groups):
        same = same & ranged[g].eqNullSafe(steps[f"__g{i}"])
    joined = ranged.join(steps, same)
    return joined.select(
        *rows.columns,
        *[
            (F.col(f"__base_{out}") + F.sum(c).over(inside) - F.col(c)).alias(out)
            for out, c in sums.items()
        ],
    )


def hash_cut_points(
    df: DataFrame, group: str, digest: str, cuts: Sequence[tuple[int, int]]
) -> dict[object, list[str | None]]:
    """Per class of ``group``: the largest digest among the first ``n * a // b`` rows.

    ``digest`` is a lower-case hex hash; ``cuts`` lists the shares ``a / b``. ``None`` marks a
    share that holds no row. Counts of hash prefixes locate the row, one scan per three hex
    digits; the last few rows are read directly.
    """
    rows = df.select(col(group).alias("g"), col(digest).alias("h")).filter("g is not null")
    counts = _prefix_counts(rows, None)
    if any(prefix is None for _, prefix in counts):
        raise AnalysisError("rows without a key cannot be split")
    sizes: dict = {}
    for (g, _), n in counts.items():
        sizes[g] = sizes.get(g, 0) + n
    answer = {g: [None] * len(cuts) for g in sizes}
    # open cuts: (class, slot) -> [prefix that holds the row, its rank below that prefix]
    searching = {
        (g, slot): ["", n * a // b]
        for g, n in sizes.items()
        for slot, (a, b) in enumerate(cuts)
        if n * a // b > 0
    }
    while searching:
        _descend(searching, counts)
        held = {(g, prefix): counts[g, prefix] for (g, _), (prefix, _) in searching.items()}
        few = {place for place, n in held.items() if n <= WINDOW_ROWS}
        _read_cut_rows(rows, few, searching, answer)
        counts = _prefix_counts(rows, set(held) - few)
    return answer


def _under(prefix: str):
    return F.substring("h", 1, len(prefix)) == prefix


def _prefix_counts(rows: DataFrame, places: set | None) -> dict:
    """Rows per class and prefix, three hex digits deeper than ``places`` (None: the start)."""
    if places is not None and not places:
        return {}
    depth, kept = PREFIX, rows
    if places is not None:
        depth += len(next(iter(places))[1])
        if depth > 32:
            raise AnalysisError("the keys of a split must be distinct")
        keep = F.lit(False)
        for g, prefix in places:
            keep = keep | ((F.col("g") == F.lit(g)) & _under(prefix))
        kept = rows.filter(keep)
    counted = kept.groupBy("g", F.substring("h", 1, depth).alias("p")).count().collect()
    return {(r.g, r.p): r["count"] for r in counted}


def _descend(searching: dict, counts: dict) -> None:
    """Move every open cut into the longer prefix that holds its row."""
    for (g, _), state in searching.items():
        prefix, left = state
        for p in sorted(p for (h, p) in counts if h == g and p.startswith(prefix)):
            if left <= counts[g, p]:
                state[0] = p
                break
            left -= counts[g, p]
        state[1] = left


def _read_cut_rows(rows: DataFrame, few: set, searching: dict, answer: dict) -> None:
    """Finish the cuts whose prefix is down to a bounded number of rows."""
    done = {k: s for k, s in searching.items() if (k[0], s[0]) in few}
    if not done:
        return
    keep, wanted = F.lit(False), F.lit(False)
    for (g, _), (prefix, rank) in done.items():
        here = (F.col("g") == F.lit(g)) & _under(prefix)
        keep = keep | here
        wanted = wanted | (here & F.col("rank").isin(rank, rank + 1))
    length = len(next(iter(done.values()))[0])
    order = Window.partitionBy("g", F.substring("h", 1, length)).orderBy("h")
    ranked = rows.filter(keep).withColumn("rank", F.row_number().over(order))
    found = {(r.g, r.h[:length], r["rank"]): r.h for r in ranked.filter(wanted).collect()}
    for (g, slot), (prefix, rank) in done.items():
        if found[g, prefix, rank] == found.get((g, prefix, rank + 1)):
            raise AnalysisError("the keys of a split must be distinct")
        answer[g][slot] = found[g, prefix, rank]
        del searching[g, slot]


def hash_order_positions(
    df: DataFrame, digest: str, out: str, groups: Iterable[str] = (), digits: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row in hash order, per group; rows without a digest come first.

    Positions are counted inside hash prefixes (even in size, whatever the group size) on top
    of the accumulated sizes of smaller prefixes. Unless ``digits`` is given, the prefixes are as
    long as the number of rows asks for. A digest in bytes is shuffled in half the space; its ``digits`` are bytes.
    """
    groups = list(groups)
    if digits is None:
        ranges = df.count() / WINDOW_ROWS
        digits = PREFIX + max(0, math.ceil(math.log(max(ranges / 16**PREFIX, 1), 16)))
    parted = df.withColumn("__prefix", F.coalesce(F.substring(col(digest), 1, digits), F.lit("").cast(df.schema[digest].dataType)))
    sizes = parted.groupBy(*groups, "__prefix").agg(F.count("*").alias("__n"))
    across = Window.partitionBy(*groups, F.lit(0)).orderBy("__prefix")
    base = sizes.select(
        *[F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)],
        F.col("__prefix").alias("__of"),
        (F.sum("__n").over(across) - F.col("__n")).alias("__base"),
    )
    inside = Window.partitionBy(*groups, "__prefix").orderBy(col(digest))
    numbered = parted.withColumn("__inside", F.row_number().over(inside))
    same = numbered["__prefix"] == base["__of"]
    for i, g in enumerate(groups):
        same = same & numbered[g].eqNullSafe(base[f"__g{i}"])
    return numbered.join(base, same).select(
        *[numbered[c] for c in df.columns], (F.col("__base") + F.col("__inside") - 1).alias(out)
    )
