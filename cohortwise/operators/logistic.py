"""Logistic regression with full covariance, and average marginal predictions.

Spark's GLM gives coefficients and standard errors but not the covariance matrix that a joint
test needs, and it does not notice separation. The fit here is Fisher scoring: each pass is
one Spark job that returns the information matrix, the score vector and the log-likelihood,
summed per task and then per entry; only these p x p numbers reach the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions.columns import col, sigmoid
from cohortwise.functions.special import NORMAL_975, chi2_sf, normal_two_sided
from cohortwise.operators.design import INTERCEPT, Design, check_rank, pattern_table
from cohortwise.operators.quantiles import exact_quantiles
from cohortwise.spec import BINARY, CONTINUOUS, AnalysisError

STANDARD = "standard_logit"
FALLBACK = "binomial_glm_pinv"
MAX_PASSES = 300
FALLBACK_PASSES = 500
HALVINGS = 30
STEP_TOLERANCE = 1e-8
PATTERNS_PER_TASK = 50_000
MAX_LOG = math.log(np.finfo(float).max)
MIN_LOG = math.log(np.finfo(float).tiny)
MARGIN_QUANTILES = (0.05, 0.25, 0.50, 0.75, 0.95)

PASS_SCHEMA = T.StructType(
    [T.StructField("slot", T.IntegerType()), T.StructField("value", T.DoubleType())]
)


@dataclass
class LogisticFit:
    design: Design
    beta: np.ndarray
    covariance: np.ndarray
    llf: float
    llf_null: float
    method: str
    passes: int
    patterns: DataFrame = field(repr=False)
    warnings: list[str] = field(default_factory=list)

    def coefficient(self, name: str) -> float:
        return float(self.beta[self.design.names.index(name)])


def _pass(patterns: DataFrame, design: Design, beta: np.ndarray) -> dict:
    """Information, score, log-likelihood and misfit at ``beta`` (scaled terms)."""
    p = len(beta)
    place = {c: f"x{i}" for i, c in enumerate(design.columns)}
    plan = [(place[t.column], t.level, design.scales.get(t.column, 1.0)) for t in design.terms]
    upper = np.triu_indices(p)

    def sums(batches):
        gram, score, tail = np.zeros((p, p)), np.zeros(p), np.zeros(2)
        for batch in batches:
            x = np.ones((len(batch), p))
            for j, (name, level, scale) in enumerate(plan, start=1):
                values = batch[name].to_numpy()
                x[:, j] = values / scale if level is None else values == level
            n, s = batch["n"].to_numpy(), batch["s"].to_numpy()
            eta = x @ beta
            mu = 1.0 / (1.0 + np.exp(-np.clip(eta, -700, 700)))
            weight = n * mu * (1.0 - mu)
            gram += x.T @ (x * weight[:, None])
            score += x.T @ (s - n * mu)
            # log(mu) = -log(1 + exp(-eta)) without overflow
            tail[0] -= s @ np.logaddexp(0.0, -eta) + (n - s) @ np.logaddexp(0.0, eta)
            tail[1] += s @ (1.0 - mu > 1e-8) + (n - s) @ (mu > 1e-8)
        values = np.concatenate([gram[upper], score, tail])
        yield pd.DataFrame({"slot": np.arange(len(values), dtype=np.int32), "value": values})

    totals = patterns.mapInPandas(sums, PASS_SCHEMA).groupBy("slot").agg(F.sum("value"))
    flat = np.zeros(len(upper[0]) + p + 2)
    for slot, value in totals.collect():
        flat[slot] = value
    gram = np.zeros((p, p))
    gram[upper] = flat[: len(upper[0])]
    gram = gram + np.triu(gram, 1).T
    return {
        "gram": gram,
        "score": flat[len(upper[0]) : len(upper[0]) + p],
        "llf": flat[-2],
        "misfit": flat[-1],
    }


def _improve(evaluate, beta, state, step):
    """Take the step, halved until the log-likelihood does not fall; else stay."""
    slack = 1e-9 * (1.0 + abs(state["llf"]))
    for passes in range(1, HALVINGS + 1):
        trial = evaluate(beta + step)
        if trial["llf"] >= state["llf"] - slack:
            return beta + step, trial, passes
        step = step / 2.0
    return beta, state, HALVINGS


def fit_logistic(df: DataFrame, design: Design, target: str) -> LogisticFit:
    """Unpenalised maximum likelihood; a pseudo-inverse run where that is unstable."""
    if design.positives in (0, design.rows):
        raise AnalysisError(f"outcome '{target}' must hold both 0 and 1")
    patterns = pattern_table(df, design, target).persist()
    # Few patterns need few tasks in each of the following passes.
    patterns = patterns.coalesce(max(1, -(-patterns.count() // PATTERNS_PER_TASK)))

    def evaluate(b):
        return _pass(patterns, design, b)

    beta = np.zeros(len(design.names))
    rate = design.positives / design.rows
    beta[0] = math.log(rate / (1.0 - rate))
    state = evaluate(beta)
    llf_null, passes = state["llf"], 1
    check_rank(state["gram"])

    method, warnings = FALLBACK, []
    while passes < MAX_PASSES:
        try:
            step = np.linalg.solve(state["gram"], state["score"])
        except np.linalg.LinAlgError:
            break
        if not np.all(np.isfinite(step)) or state["misfit"] == 0:
            break
        beta, state, used = _improve(evaluate, beta, state, step)
        passes += used
        if np.max(np.abs(step)) < STEP_TOLERANCE:
            method = STANDARD
            break

    if method == FALLBACK:
        warnings.append("the standard fit was unstable; refitted with a pseudo-inverse")
        beta, state, passes = _pinv_fit(evaluate, beta, state, passes)

    covariance = (
        np.linalg.inv(state["gram"]) if method == STANDARD else np.linalg.pinv(state["gram"])
    )
    scale = np.array([1.0, *[design.scales.get(t.column, 1.0) for t in design.terms]])
    return LogisticFit(
        design, beta / scale, covariance / np.outer(scale, scale), float(state["llf"]), float(llf_null),
        method, passes, patterns, warnings,
    )


def _pinv_fit(evaluate, beta, state, passes):
    """Iterate on the deviance alone, which settles under quasi-separation too."""
    for _ in range(FALLBACK_PASSES):
        if state["misfit"] == 0:
            break
        step = np.linalg.pinv(state["gram"]) @ state["score"]
        before = state["llf"]
        beta, state, used = _improve(evaluate, beta, state, step)
        passes += used
        if 2.0 * abs(state["llf"] - before) <= max(1e-8, 1e-13 * abs(before)):
            if state["misfit"] == 0:
                break
            return beta, state, passes
    raise AnalysisError(
        "this combination of variables cannot be estimated: sparse levels, complete separation "
        "or strong overlap between variables"
    )


def safe_exp(value: float) -> float | None:
    """exp without overflow or underflow."""
    if not math.isfinite(value) or value > MAX_LOG or value < MIN_LOG:
        return None
    return math.exp(value)


def exposure_effects(fit: LogisticFit) -> list[dict]:
    """Coefficient, odds ratio, 95 % interval and p-value of every exposure term."""
    rows = []
    for term in fit.design.exposure_terms:
        j = fit.design.names.index(term.name)
        beta, variance = float(fit.beta[j]), float(fit.covariance[j, j])
        se = math.sqrt(variance) if variance > 0 else math.nan
        p = normal_two_sided(beta / se) if se > 0 else math.nan
        ratio = safe_exp(beta)
        low, high = safe_exp(beta - NORMAL_975 * se), safe_exp(beta + NORMAL_975 * se)
        estimable = None not in (ratio, low, high) and math.isfinite(p)
        rows.append(
            {
                "term": term.name,
                "coefficient": beta if math.isfinite(beta) else None,
                "odds_ratio": ratio if estimable else None,
                "p_value": p if math.isfinite(p) else None,
                "ci_95_low": low if estimable else None,
                "ci_95_high": high if estimable else None,
                "estimable": estimable,
                "warning": None if estimable
                else f"'{term.name}' is (nearly) separated; its odds ratio is not estimable",
            }
        )
    return rows


EFFECT_SCHEMA = (
    "term string, coefficient double, odds_ratio double, p_value double, ci_95_low double, "
    "ci_95_high double, estimable boolean, warning string"
)
DIAGNOSTIC_SCHEMA = (
    "fit_method string, converged boolean, n_observations bigint, pseudo_r_squared double, "
    "aic double, bic double, adjustment_applied boolean"
)
WALD_SCHEMA = (
    "method string, estimable boolean, statistic double, degrees_of_freedom int, p_value double, "
    "warning string"
)


def effects_frame(fit: LogisticFit) -> DataFrame:
    """The coefficient table of the exposure; a handful of rows made from the fit."""
    return fit.patterns.sparkSession.createDataFrame(exposure_effects(fit), EFFECT_SCHEMA)


def diagnostics(fit: LogisticFit, adjusted: bool) -> dict:
    k, n = len(fit.beta), fit.design.rows
    return {
        "fit_method": fit.method,
        "converged": True,
        "n_observations": n,
        "pseudo_r_squared": 1.0 - fit.llf / fit.llf_null if fit.llf_null else None,
        "aic": 2.0 * k - 2.0 * fit.llf,
        "bic": k * math.log(n) - 2.0 * fit.llf,
        "adjustment_applied": adjusted,
    }


def joint_wald(fit: LogisticFit) -> dict:
    """Are all exposure coefficients zero at once?"""
    names = [t.name for t in fit.design.exposure_terms]
    where = [fit.design.names.index(n) for n in names]
    base = {"method": "joint_wald_test", "degrees_of_freedom": len(names)}
    beta, cov = fit.beta[where], fit.covariance[np.ix_(where, where)]
    try:
        statistic = float(beta @ np.linalg.solve(cov, beta))
    except np.linalg.LinAlgError:
        statistic = math.nan
    if not math.isfinite(statistic) or statistic < 0:
        return {
            **base, "estimable": False, "statistic": None, "p_value": None,
            "warning": "the covariance matrix is unstable; no joint test",
        }
    p = chi2_sf(statistic, len(names))
    return {**base, "estimable": True, "statistic": statistic, "p_value": p, "warning": None}


def margin_grid(df: DataFrame, design: Design) -> list[tuple[str, dict[str, float]]]:
    """Exposure values to predict at, each with the values its terms take."""
    names = [t.name for t in design.exposure_terms]
    if design.kind == CONTINUOUS:
        values: list[float] = []
        for q in exact_quantiles(df, [design.exposure], MARGIN_QUANTILES)[design.exposure]:
            if not any(np.isclose(q, v) for v in values):
                values.append(q)
        if len(values) < 2:
            x = col(design.exposure).cast("double")
            low, high = df.agg(F.min(x), F.max(x)).first()
            values = [low] if np.isclose(low, high) else [low, high]
        return [(repr(v), {design.exposure: v}) for v in values]
    levels = design.levels[design.exposure]
    if design.kind == BINARY:
        return [(levels[0], {names[0]: 0.0}), (levels[1], {names[0]: 1.0})]
    zero = dict.fromkeys(names, 0.0)
    grid = [(levels[0], zero)]
    grid += [(levels[t.level], {**zero, t.name: 1.0}) for t in design.exposure_terms]
    return grid


def linear_without_exposure(fit: LogisticFit) -> Column:
    """The linear predictor of a pattern row from the intercept and the controls."""
    design = fit.design
    place = {c: f"x{i}" for i, c in enumerate(design.columns)}
    eta = F.lit(fit.coefficient(INTERCEPT))
    for c in design.columns:
        if c == design.exposure:
            continue
        if c in design.levels:
            found = {t.level: fit.coefficient(t.name) for t in design.terms if t.column == c}
            part = [F.lit(found.get(j, 0.0)) for j in range(len(design.levels[c]))]
            eta = eta + F.element_at(F.array(*part), F.col(place[c]).cast("int") + 1)
        else:
            eta = eta + fit.coefficient(c) * F.col(place[c])
    return eta


def average_margins(fit: LogisticFit, grid: list[tuple[str, dict[str, float]]]) -> DataFrame:
    """Mean predicted probability per grid value; every value in the same single aggregate."""
    eta = linear_without_exposure(fit)
    total = F.sum("n")
    sums = []
    for i, (_, overrides) in enumerate(grid):
        shift = sum(fit.coefficient(name) * value for name, value in overrides.items())
        sums.append((F.sum(F.col("n") * sigmoid(F.col("__eta") + shift)) / total).alias(f"m{i}"))
    means = fit.patterns.withColumn("__eta", eta).agg(*sums)
    entries = []
    for i, (label, _) in enumerate(grid):
        mean = F.col(f"m{i}")
        problem = F.raise_error(F.lit("a mean probability left [0, 1]")).cast("double")
        entries.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(label).alias("exposure_value"),
                F.when((mean >= 0) & (mean <= 1), mean).otherwise(problem)
                .alias("adjusted_probability"),
            )
        )
    return means.select(F.inline(F.array(*entries)))
