"""Propensity scores, common support and caliper (M1-M7)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, sigmoid
from cohortwise.operators.cleaning import coerce_numeric
from cohortwise.operators.quantiles import exact_quantiles
from cohortwise.operators.unadjusted import levels_of
from cohortwise.spec import AnalysisError, CohortSpec

MISSING_LEVEL = "__MISSING__"
MIN_GROUP = 2
INVERSE_PENALTY = 1.0
MAX_ITERATIONS = 2000
CLIP = 1e-6
CALIPER_SDS = 0.2
MIN_CALIPER = 1e-12

SCORE = "propensity_score"
LOGIT = "propensity_logit"


def prepare_covariates(df: DataFrame, covariates, spec: CohortSpec) -> DataFrame:
    """Continuous covariates as doubles (null where they do not parse), others as text."""
    numeric, other = spec.split(covariates)
    df = coerce_numeric(df, numeric)
    return df.select(
        *[col(c).cast("string").alias(c) if c in other else col(c) for c in df.columns]
    )


@dataclass(frozen=True)
class FeaturePlan:
    """How covariates become model features; learned from all analysed rows."""

    numeric: dict[str, tuple[float, float, float]]  # median, mean, deviation after imputation
    levels: dict[str, list[str]]

    def columns(self) -> dict[str, Column]:
        features: dict[str, Column] = {}
        for c, (median, mean, sd) in self.numeric.items():
            features[c] = (F.coalesce(col(c), F.lit(median)) - mean) / sd
        for c, levels in self.levels.items():
            text = F.coalesce(col(c), F.lit(MISSING_LEVEL))
            for level in levels:
                features[f"{c}_{level}"] = (text == level).cast("double")
        return features

    def linear(self, intercept: float, coefficients: list[float]) -> Column:
        """Intercept plus the weighted features; a level looks its coefficient up."""
        weights = dict(zip(self.columns(), map(float, coefficients), strict=True))
        eta = F.lit(float(intercept))
        for c, (median, mean, sd) in self.numeric.items():
            eta = eta + (F.coalesce(col(c), F.lit(median)) - mean) / sd * weights[c]
        for c, levels in self.levels.items():
            text = F.coalesce(col(c), F.lit(MISSING_LEVEL))
            found = F.array_position(F.array(*[F.lit(v) for v in levels]), text).cast("int")
            eta = eta + F.element_at(F.array(*[F.lit(weights[f"{c}_{v}"]) for v in levels]), found)
        return eta


def plan_features(df: DataFrame, covariates, spec: CohortSpec) -> FeaturePlan:
    """Median imputation and population scaling; one indicator per level, missing included."""
    numeric, other = spec.split(covariates)
    if not numeric and not other:
        raise AnalysisError("matching needs at least one covariate")
    scaled: dict[str, tuple[float, float, float]] = {}
    if numeric:
        medians = {c: q[0] for c, q in exact_quantiles(df, numeric, [0.5]).items()}
        empty = [c for c, m in medians.items() if m is None]
        if empty:
            raise AnalysisError(f"covariates without any value: {empty}")
        filled = {c: F.coalesce(col(c), F.lit(medians[c])) for c in numeric}
        row = df.agg(*[f(filled[c]) for c in numeric for f in (F.avg, F.stddev_pop)]).first()
        for i, c in enumerate(numeric):
            scaled[c] = (medians[c], row[2 * i], row[2 * i + 1] or 1.0)
    texts = df.select(*[F.coalesce(col(c), F.lit(MISSING_LEVEL)).alias(c) for c in other])
    return FeaturePlan(scaled, levels_of(texts, other))


def propensity_features(df: DataFrame, plan: FeaturePlan, keep: list[str]) -> DataFrame:
    """The kept columns and one column per model feature."""
    return df.select(
        *[col(c) for c in keep], *[f.alias(name) for name, f in plan.columns().items()]
    )


def score_propensity(df: DataFrame, code: str, covariates, spec: CohortSpec) -> DataFrame:
    """Add the probability of the comparison group from an L2-penalised logistic model.

    Where many rows share their covariates, the model is fitted on the distinct patterns,
    weighted by their number of rows; the optimum is the same. Scores are plain expressions.
    """
    plan = plan_features(df, covariates, spec)
    names = {f"__f{i}": f for i, f in enumerate(plan.columns().values())}
    used = [col(c) for c in covariates]
    size = df.agg(
        F.count("*").alias("rows"), F.approx_count_distinct(F.xxhash64(*used)).alias("patterns")
    ).first()
    if size.patterns * 2 <= size.rows:
        weighted = df.groupBy(col(code), *used).agg(F.count("*").cast("double").alias("__n"))
    else:
        weighted = df.select(col(code), *used, F.lit(1.0).alias("__n"))
    wide = weighted.select(col(code), "__n", *[f.alias(n) for n, f in names.items()])
    ready = VectorAssembler(inputCols=list(names), outputCol="__features").transform(wide)
    model = LogisticRegression(
        featuresCol="__features",
        labelCol=code,
        weightCol="__n",
        regParam=1.0 / (INVERSE_PENALTY * size.rows),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=MAX_ITERATIONS,
        tol=1e-10,
    ).fit(ready.select(col(code), "__n", "__features"))
    return df.withColumn(SCORE, sigmoid(plan.linear(model.intercept, list(model.coefficients))))


def group_sizes(df: DataFrame, code: str) -> DataFrame:
    """Rows and score range per exposure group."""
    return df.groupBy(col(code).alias("code")).agg(
        F.count("*").alias("n"), F.min(SCORE).alias("lowest"), F.max(SCORE).alias("highest")
    )


def check_group_sizes(sizes: dict[int, int], where: str) -> None:
    if min(sizes.get(0, 0), sizes.get(1, 0)) < MIN_GROUP:
        raise AnalysisError(f"matching needs {MIN_GROUP} rows in both groups {where}: {sizes}")


def support_bounds(df: DataFrame, code: str) -> DataFrame:
    """One row: the score range seen in both groups, and group sizes."""
    groups = group_sizes(df, code)

    def size(g: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("code") == g, F.col("n"))), F.lit(0)).cast("bigint")

    return groups.agg(
        F.max("lowest").alias("common_support_lower"),
        F.min("highest").alias("common_support_upper"),
        size(1).alias("comparison_n"),
        size(0).alias("reference_n"),
    )


def add_logit(df: DataFrame) -> DataFrame:
    """Add the logit of the clipped score."""
    p = F.least(F.greatest(F.col(SCORE), F.lit(CLIP)), F.lit(1 - CLIP))
    return df.withColumn(LOGIT, F.log(p / (1 - p)) + 0.0)


def caliper(df: DataFrame) -> DataFrame:
    """One row: the matching caliper from the logits of all analysed rows."""
    return df.agg(
        F.greatest(F.lit(CALIPER_SDS) * F.stddev_samp(LOGIT), F.lit(MIN_CALIPER)).alias("caliper")
    )


def on_support(df: DataFrame, low: float, high: float) -> DataFrame:
    if low > high:
        raise AnalysisError("the two groups have no common score range")
    return df.filter(F.col(SCORE).between(low, high))
