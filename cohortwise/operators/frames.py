"""Result tables in the shape charts need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.spec import AnalysisError

TOP_COVARIATES = 20
TOP_IMPACTS = 8


def rate_frame(rates: DataFrame) -> DataFrame:
    """Level, sample size and rate in percent, highest rate first."""
    return rates.select(
        "level", F.col("n").alias("sample_size"), (F.col("target_rate") * 100).alias("rate_percent")
    ).orderBy(F.desc("rate_percent"), "level")


def forest_frame(effects: DataFrame) -> DataFrame:
    """Estimable odds ratios with the length of their error bars, smallest first."""
    usable = effects.filter(
        F.col("estimable") & F.col("odds_ratio").isNotNull()
        & F.col("ci_95_low").isNotNull() & F.col("ci_95_high").isNotNull()
    )
    return usable.select(
        "term",
        "odds_ratio",
        "ci_95_low",
        "ci_95_high",
        "p_value",
        (F.col("ci_95_high") - F.col("odds_ratio")).alias("error_plus"),
        (F.col("odds_ratio") - F.col("ci_95_low")).alias("error_minus"),
    ).orderBy("odds_ratio")


def margin_frame(margins: DataFrame) -> DataFrame:
    """Average predicted probability in percent; numeric exposure values in numeric order."""
    number = F.col("exposure_value").try_cast("double")
    return margins.select(
        "exposure_value",
        (F.col("adjusted_probability") * 100).alias("probability_percent"),
        number.alias("numeric_value"),
    ).orderBy(F.asc_nulls_last("numeric_value"), "exposure_value")


def love_frame(balance: DataFrame, top: int = TOP_COVARIATES) -> DataFrame:
    """The ``top`` covariates by their larger difference before or after matching."""
    if top < 1:
        raise AnalysisError("top must be at least 1")

    def finite(name: str) -> Column:
        c = F.abs(F.col(name))
        return F.when((c < float("inf")) & ~F.isnan(c), c)

    largest = F.greatest(finite("smd_before"), finite("smd_after"))
    return (
        balance.withColumn("max_smd", largest)
        .orderBy(F.desc_nulls_last("max_smd"), "covariate")
        .limit(top)
        .orderBy(F.asc_nulls_first("max_smd"), F.desc("covariate"))
    )


def impact_text(points: Column) -> Column:
    """Percentage points with more digits where they are small."""
    sign = F.when(points >= 0, "+").otherwise("-")
    size = F.abs(points)
    return (
        F.when(size < 0.001, "0.000%p")
        .when(size < 0.01, F.concat(sign, F.format_string("%.3f", size), F.lit("%p")))
        .otherwise(F.concat(sign, F.format_string("%.2f", size), F.lit("%p")))
    )


def top_impacts(impacts: DataFrame, key: str, top: int = TOP_IMPACTS) -> DataFrame:
    """The largest impacts of each record, in signed order; a record has one row per feature."""
    size = F.abs(F.col("impact_percentage_points"))
    by_size = Window.partitionBy(key).orderBy(size.desc(), "feature")
    by_sign = Window.partitionBy(key).orderBy("impact_percentage_points", "feature")
    return (
        impacts.withColumn("__rank", F.row_number().over(by_size))
        .filter(F.col("__rank") <= top)
        .withColumn("position", F.row_number().over(by_sign))
        .withColumn("impact_text", impact_text(F.col("impact_percentage_points")))
        .drop("__rank")
    )


def top_record_impacts(records: DataFrame, key: str, top: int = TOP_IMPACTS) -> DataFrame:
    """``top_impacts`` of records that hold their impacts as an array: sorted inside the record, nothing is shuffled."""
    points = F.transform("__impacts", lambda e: F.struct(
        (e["impact_probability"] * 100).alias("points"), e["feature"].alias("feature")
    ))
    # a missing impact comes last by size and first by sign, NaN first by size and last by sign
    ranked = F.array_sort(F.transform(points, lambda e: F.struct(
        e["points"].isNull().alias("missing"), (~F.isnan(e["points"])).alias("finite"), (-F.abs(e["points"])).alias("order"),
        e["feature"].alias("feature"), e["points"].alias("points"),
    )))
    signed = F.array_sort(F.transform(F.slice(ranked, 1, top), lambda e: F.struct(e["points"], e["feature"])))
    placed = records.select(col(key), F.posexplode(signed).alias("__place", "__e"))
    return placed.select(
        col(key), F.col("__e")["feature"].alias("feature"), (F.col("__place") + 1).alias("position"),
        F.col("__e")["points"].alias("impact_percentage_points"),
        impact_text(F.col("__e")["points"]).alias("impact_text"),
    )


def what_if_frame(grid: DataFrame, current: str) -> DataFrame:
    """What-if points with the current value flagged and a number to sort continuous ones by."""
    number = F.col("value").try_cast("double")
    here = col(current).try_cast("double")
    same = F.coalesce(number == here, F.col("value") == col(current).cast("string"))
    return grid.withColumn("numeric_value", number).withColumn("is_current", same)


def importance_frame(importance: DataFrame, top: int = 10) -> DataFrame:
    """The ``top`` features by mean importance."""
    return importance.orderBy(F.desc("importance_mean"), "feature").limit(top)


def with_labels(df: DataFrame, column: str, labels: dict[str, str], out: str = "label") -> DataFrame:
    """Add display labels; codes without one keep their code."""
    rows = df.sparkSession.createDataFrame(
        [(k, v) for k, v in labels.items()] or [("", "")], f"__code string, {out} string"
    )
    # The label table is a dictionary written by hand, a few rows long.
    joined = df.join(F.broadcast(rows), col(column) == F.col("__code"), "left").drop("__code")
    return joined.withColumn(out, F.coalesce(out, col(column).cast("string")))


def probability_record(df: DataFrame, probability: str) -> DataFrame:
    """Probability in percent; values outside [0, 1] fail when the query runs."""
    p = col(probability)
    problem = F.raise_error(F.lit(f"'{probability}' must be between 0 and 1")).cast("double")
    fine = p.isNotNull() & ~F.isnan(p) & (p >= 0) & (p <= 1)
    return df.withColumn("probability_percent", F.when(fine, p * 100).otherwise(problem))
