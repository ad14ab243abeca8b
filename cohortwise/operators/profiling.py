"""Profiling tables for a cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions.columns import col, is_missing, rate
from cohortwise.operators.cleaning import string_columns, validate_profile_input
from cohortwise.operators.quantiles import exact_quantiles

MISSING_CATEGORY = "<NA>"


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _stack(summary: DataFrame, fields: dict[str, list]) -> DataFrame:
    """Turn a one-row summary into one row per entry; ``fields`` maps names to columns."""
    entries = [
        F.struct(*[c.alias(name) for name, c in zip(fields, row, strict=True)])
        for row in zip(*fields.values(), strict=True)
    ]
    return summary.select(F.inline(F.array(*entries)))


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and rate per column, most missing first."""
    counts = df.agg(
        F.count("*").alias("__rows"),
        *[F.count_if(is_missing(df, n)).alias(f"m{i}") for i, n in enumerate(df.columns)],
    )
    slots = range(len(df.columns))
    table = _stack(
        counts,
        {
            "column": [F.lit(n) for n in df.columns],
            "dtype": [F.lit(t) for _, t in df.dtypes],
            "missing_count": [F.col(f"m{i}") for i in slots],
            "missing_rate": [rate(F.col(f"m{i}"), F.col("__rows"), 0.0) for i in slots],
        },
    )
    return table.orderBy(F.desc("missing_count"), "column")


def duplicate_summary(df: DataFrame) -> DataFrame:
    """Rows, rows equal to an earlier row, and their share."""
    groups = df.groupBy(*[col(n) for n in df.columns]).agg(F.count("*").alias("__n"))
    rows = F.coalesce(F.sum("__n"), F.lit(0)).cast("bigint")
    repeats = F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint")
    return groups.agg(rows.alias("row_count"), repeats.alias("duplicate_rows")).withColumn(
        "duplicate_rate", rate(F.col("duplicate_rows"), F.col("row_count"), 0.0)
    )


def describe_numeric(df: DataFrame) -> DataFrame:
    """Count, mean, sample deviation, range, quartiles and missing count per numeric column."""
    names = numeric_columns(df)
    present = df.select(
        *[F.when(~is_missing(df, n), col(n).cast("double")).alias(f"v{i}")
          for i, n in enumerate(names)]
    )
    slots = range(len(names))
    moments = present.agg(
        F.count("*").alias("__rows"),
        *[
            f(F.col(f"v{i}")).alias(f"{label}{i}")
            for i in slots
            for label, f in (
                ("n", F.count), ("avg", F.avg), ("sd", F.stddev_samp), ("lo", F.min), ("hi", F.max)
            )
        ],
    )
    quartiles = exact_quantiles(present, [f"v{i}" for i in slots], [0.25, 0.5, 0.75])

    def at(q: int) -> list:
        return [F.lit(quartiles[f"v{i}"][q]).cast("double") for i in slots]

    return _stack(
        moments,
        {
            "column": [F.lit(n) for n in names],
            "count": [F.col(f"n{i}") for i in slots],
            "mean": [F.col(f"avg{i}") for i in slots],
            "std": [F.col(f"sd{i}") for i in slots],
            "min": [F.col(f"lo{i}") for i in slots],
            "q1": at(0),
            "median": at(1),
            "q3": at(2),
            "max": [F.col(f"hi{i}") for i in slots],
            "missing_count": [F.col("__rows") - F.col(f"n{i}") for i in slots],
        },
    )


def category_frequencies(df: DataFrame) -> DataFrame:
    """Count and share of all rows per level of every text column; nulls are a level."""
    names = string_columns(df)
    counted = (
        df.select(*[col(n) for n in names])
        .unpivot([], names, "column", "category")
        .groupBy("column", F.coalesce("category", F.lit(MISSING_CATEGORY)).alias("category"))
        .agg(F.count("*").alias("count"))
    )
    totals = counted.groupBy("column").agg(F.sum("count").alias("__rows"))
    return (
        counted.join(F.broadcast(totals), "column")  # one row per text column
        .select("column", "category", "count", rate(F.col("count"), F.col("__rows")).alias("proportion"))
        .orderBy("column", F.desc("count"), "category")
    )


def target_summary(df: DataFrame, target: str) -> DataFrame:
    """Known, missing, low and high outcomes and the rate among the known ones."""
    t = col(target)
    return df.agg(
        F.count(t).alias("valid_count"),
        F.count_if(t.isNull()).alias("missing_count"),
        F.count_if(t == 0).alias("low_count"),
        F.count_if(t == 1).alias("high_count"),
    ).withColumn("high_rate", rate(F.col("high_count"), F.col("valid_count"), 0.0))


def profile_overview(df: DataFrame, target: str) -> DataFrame:
    """One row of table-level counts; missing cells and duplicates come from one shuffle."""
    gaps = [is_missing(df, n) for n in df.columns]
    keyed = df.groupBy(*[col(n) for n in df.columns]).agg(F.count("*").alias("__n"))
    n = F.col("__n")
    cells = [F.sum(F.when(g, n).otherwise(0)) for g in gaps]
    t = col(target)
    total_cells, with_missing = cells[0], (cells[0] > 0).cast("bigint")
    for c in cells[1:]:
        total_cells, with_missing = total_cells + c, with_missing + (c > 0).cast("bigint")
    valid = F.coalesce(F.sum(F.when(t.isNotNull(), n)), F.lit(0))
    high = F.coalesce(F.sum(F.when(t == 1, n)), F.lit(0))
    return keyed.agg(
        F.sum(n).alias("rows"),
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        total_cells.cast("bigint").alias("missing_cells"),
        with_missing.alias("columns_with_missing"),
        F.sum(n - 1).alias("duplicate_rows"),
        valid.alias("valid_targets"),
        high.alias("high_count"),
        rate(high, valid, 0.0).alias("high_rate"),
    )


def full_profile(df: DataFrame, target: str) -> dict[str, DataFrame]:
    """All profiling tables of one cohort, over one persisted copy of it."""
    df = df.persist()
    validate_profile_input(df, target)
    return {
        "overview": profile_overview(df, target),
        "target": target_summary(df, target),
        "missing": missing_values(df),
        "duplicates": duplicate_summary(df),
        "numeric": describe_numeric(df),
        "categories": category_frequencies(df),
    }
