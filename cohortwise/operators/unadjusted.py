"""Association of one exposure with a binary outcome, without controls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, rate
from cohortwise.functions.pvalues import chi2_sf, fisher_two_sided, t_two_sided
from cohortwise.functions.special import NORMAL_975
from cohortwise.spec import AnalysisError

SIGNIFICANCE = 0.05
MAX_LEVELS = 10_000


def distinct_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """The distinct non-null levels of text or code columns: ``column, level``."""
    entries = [
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("level")) for c in columns
    ]
    return df.select(F.inline(F.array(*entries))).filter(F.col("level").isNotNull()).distinct()


def ordered_levels(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per column: its levels in text order."""
    return distinct_levels(df, columns).groupBy("column").agg(
        F.array_sort(F.collect_list("level")).alias("levels")
    )


def levels_of(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Levels on the driver, as terms of a model; a column with too many of them is no model term.

    A model holds a matrix of terms by terms, so the bound is on what it can hold, per column.
    """
    if not columns:
        return {}
    distinct = distinct_levels(df, columns).persist()  # read twice; the rows behind it once
    counts = distinct.groupBy("column").agg(F.count("*").alias("n")).collect()
    large = {r.column: r.n for r in counts if r.n > MAX_LEVELS}
    if large:
        raise AnalysisError(f"columns with more than {MAX_LEVELS} levels: {large}")
    found = distinct.collect()
    distinct.unpersist()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for r in found:
        levels[r.column].append(r.level)
    # Code point order, as the engine sorts UTF-8.
    return {c: sorted(v) for c, v in levels.items()}


def group_rates(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """Rows, positives and outcome rate per non-null exposure level."""
    level, y = col(exposure).cast("string"), col(outcome).cast("int")
    return (
        df.filter(level.isNotNull() & y.isNotNull())
        .groupBy(level.alias("level"))
        .agg(F.count("*").alias("n"), F.sum(y).cast("bigint").alias("high"))
        .withColumn("target_rate", rate(F.col("high"), F.col("n")))
    )


def encode_binary(df: DataFrame, exposure: str, out: str) -> DataFrame:
    """Add 0 for the first level in text order and 1 for the second.

    More or fewer than two levels fail when the query runs.
    """
    extremes = df.agg(
        F.min(col(exposure).cast("string")).alias("low"),
        F.max(col(exposure).cast("string")).alias("high"),
    ).first()
    level = col(exposure).cast("string")
    problem = F.raise_error(F.concat(F.lit(f"'{exposure}' has more than two levels: "), level))
    code = (
        F.when(level.isNull(), F.lit(None).cast("int"))
        .when(level == extremes.low, F.lit(0))
        .when(level == extremes.high, F.lit(1))
        .otherwise(problem.cast("int"))
    )
    if extremes.low == extremes.high:
        code = F.raise_error(F.lit(f"'{exposure}' does not have two levels")).cast("int")
    return df.withColumn(out, code)


def two_by_two(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """One row: the levels and cells of the 2x2 table, reference level first in text order."""
    groups = group_rates(df, exposure, outcome)
    counted = F.count("*")
    row = groups.agg(
        F.when(
            counted != 2,
            F.raise_error(F.concat(F.lit(f"'{exposure}' must have two levels, found "), counted)),
        ).alias("__check"),
        F.min("level").alias("reference_level"),
        F.max("level").alias("comparison_level"),
        F.min_by("n", "level").alias("reference_n"),
        F.max_by("n", "level").alias("comparison_n"),
        F.min_by("high", "level").alias("reference_high"),
        F.max_by("high", "level").alias("comparison_high"),
    )
    # coalesce keeps the check in the plan: it is null for a good table.
    return row.withColumn(
        "reference_level", F.coalesce(F.col("__check").cast("string"), "reference_level")
    ).drop("__check")


def odds_ratio_columns(a: Column, b: Column, c: Column, d: Column) -> dict[str, Column]:
    """Odds ratio with its 95 % interval; half a count is added to all cells if one is zero."""
    shift = F.when((a == 0) | (b == 0) | (c == 0) | (d == 0), 0.5).otherwise(0.0)
    a, b, c, d = (x + shift for x in (a, b, c, d))
    ratio = (a * d) / (b * c)
    spread = NORMAL_975 * F.sqrt(1 / a + 1 / b + 1 / c + 1 / d)
    return {
        "odds_ratio": ratio,
        "odds_ratio_ci_95_low": F.exp(F.log(ratio) - spread),
        "odds_ratio_ci_95_high": F.exp(F.log(ratio) + spread),
    }


def binary_association(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """One row: rates, differences, odds ratio, effect size and exact test of two groups."""
    cells = two_by_two(df, exposure, outcome)
    high1, high0 = F.col("comparison_high"), F.col("reference_high")
    low1, low0 = F.col("comparison_n") - high1, F.col("reference_n") - high0
    p1, p0 = rate(high1, F.col("comparison_n")), rate(high0, F.col("reference_n"))
    return cells.select(
        "reference_level",
        "comparison_level",
        "reference_n",
        "comparison_n",
        p0.alias("reference_rate"),
        p1.alias("comparison_rate"),
        (p1 - p0).alias("rate_difference"),
        rate(p1, p0).alias("risk_ratio"),
        *[c.alias(n) for n, c in odds_ratio_columns(high1, low1, high0, low0).items()],
        (2 * F.asin(F.sqrt(p1)) - 2 * F.asin(F.sqrt(p0))).alias("cohens_h"),
        fisher_two_sided(high1, low1, high0, low0).alias("fisher_exact_p_value"),
    )


def point_biserial(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """One row: correlation of a continuous exposure with the outcome, and its p-value."""
    return point_biserials(df, [exposure], outcome).drop("exposure")


def point_biserials(df: DataFrame, exposures: list[str], outcome: str) -> DataFrame:
    """One row per exposure, from a single aggregate over the rows."""
    y, measures = col(outcome).cast("double"), []
    for i, exposure in enumerate(exposures):
        x = F.when(y.isNotNull(), col(exposure).cast("double"))
        measures += [
            F.count(x).alias(f"n{i}"),
            F.min(x).alias(f"lo{i}"),
            F.max(x).alias(f"hi{i}"),
            F.corr(F.when(x.isNotNull(), y), x).alias(f"r{i}"),
            F.avg(x).alias(f"m{i}"),
            F.stddev_samp(x).alias(f"s{i}"),
        ]
    entries = [
        F.struct(
            F.lit(exposure).alias("exposure"),
            F.col(f"n{i}").alias("n"),
            F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.raise_error(F.lit(f"'{exposure}' is constant")).cast("double"))
            .otherwise(F.col(f"r{i}"))
            .alias("correlation"),
            F.col(f"m{i}").alias("exposure_mean"),
            F.col(f"s{i}").alias("exposure_std"),
        )
        for i, exposure in enumerate(exposures)
    ]
    rows = df.agg(*measures).select(F.inline(F.array(*entries)))
    r, dof = F.col("correlation"), (F.col("n") - 2).cast("double")
    t = F.when(F.abs(r) < 1.0, r * F.sqrt(dof / (1 - r * r))).otherwise(F.lit(float("inf")))
    return rows.withColumn("p_value", t_two_sided(t, dof))


def category_rates(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """Outcome rate per level, highest first."""
    return group_rates(df, exposure, outcome).orderBy(F.desc("target_rate"), "level")


def contingency(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """Level by outcome counts, zero-filled."""
    groups = group_rates(df, exposure, outcome)
    return groups.select(
        "level", (F.col("n") - F.col("high")).alias("low"), F.col("high")
    )


def chi_square(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """One row: independence test of a level by outcome table.

    The continuity correction applies to two levels only. Level counts are summed twice from
    the same small grouped table: once for the margins, once for the cells.
    """
    cells = contingency(df, exposure, outcome)
    margins = cells.agg(
        F.sum("low").alias("all_low"),
        F.sum("high").alias("all_high"),
        F.count("*").alias("level_count"),
    )
    total = F.col("all_low") + F.col("all_high")
    level = F.col("low") + F.col("high")
    table = cells.join(F.broadcast(margins))  # one row of margins
    table = table.select(
        "level_count",
        F.inline(
            F.array(
                F.struct(F.col("low").alias("seen"), (level * F.col("all_low") / total).alias("expected")),
                F.struct(F.col("high").alias("seen"), (level * F.col("all_high") / total).alias("expected")),
            )
        ),
    )
    gap = F.abs(F.col("seen") - F.col("expected"))
    gap = F.when(F.col("level_count") == 2, gap - F.least(F.lit(0.5), gap)).otherwise(gap)
    return (
        table.agg(
            F.sum(gap * gap / F.col("expected")).alias("chi2_statistic"),
            (F.first("level_count") - 1).alias("degrees_of_freedom"),
            F.min("expected").alias("minimum_expected_count"),
            F.count_if(F.col("expected") < 5).alias("expected_cells_under_5"),
        )
        .withColumn("chi2_p_value", chi2_sf("chi2_statistic", F.col("degrees_of_freedom").cast("double")))
    )


def extreme_levels(df: DataFrame, exposure: str, outcome: str) -> DataFrame:
    """One row: the levels with the highest and lowest outcome rate."""
    groups = group_rates(df, exposure, outcome)
    highest = F.struct(-F.col("target_rate"), F.col("level"))
    lowest = F.struct(F.col("target_rate"), F.col("level"))
    return groups.agg(
        F.min_by("level", highest).alias("highest_level"),
        F.max("target_rate").alias("highest_rate"),
        F.min_by("level", lowest).alias("lowest_level"),
        F.min("target_rate").alias("lowest_rate"),
    )


def verdict(p_value: Column, effect: Column) -> Column:
    """positive / negative where significant, otherwise none."""
    return (
        F.when((p_value < SIGNIFICANCE) & (effect > 0), "positive")
        .when((p_value < SIGNIFICANCE) & (effect < 0), "negative")
        .otherwise("none")
    )


def welch_test(df: DataFrame, group: str, value: str) -> DataFrame:
    """One row: unequal-variance comparison of the mean of ``value`` in two groups."""
    g, v = col(group).cast("string"), col(value).cast("double")
    stats = (
        df.filter(g.isNotNull() & v.isNotNull())
        .groupBy(g.alias("level"))
        .agg(F.count("*").alias("n"), F.avg(v).alias("mean"), F.var_samp(v).alias("var"))
    )
    row = stats.agg(
        *[
            f(F.struct("level", "n", "mean", "var")).alias(name)
            for f, name in ((F.min, "a"), (F.max, "b"))
        ]
    )
    se_a, se_b = F.col("a.var") / F.col("a.n"), F.col("b.var") / F.col("b.n")
    difference = F.col("b.mean") - F.col("a.mean")
    t = difference / F.sqrt(se_a + se_b)
    dof = (se_a + se_b) ** 2 / (
        se_a**2 / (F.col("a.n") - 1) + se_b**2 / (F.col("b.n") - 1)
    )
    return (
        row.select(
            F.col("a.level").alias("reference_level"),
            F.col("b.level").alias("comparison_level"),
            F.col("a.n").alias("reference_n"),
            F.col("b.n").alias("comparison_n"),
            F.col("a.mean").alias("reference_mean"),
            F.col("b.mean").alias("comparison_mean"),
            difference.alias("mean_difference"),
            t.alias("t_statistic"),
            dof.alias("degrees_of_freedom"),
        )
        .withColumn("p_value", t_two_sided("t_statistic", "degrees_of_freedom"))
        .withColumn("significant", F.col("p_value") < SIGNIFICANCE)
    )
