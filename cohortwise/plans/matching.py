"""Propensity-score matching end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, require_columns
from cohortwise.operators import balance, matching, propensity
from cohortwise.operators.cleaning import validate_binary_outcome
from cohortwise.operators.unadjusted import encode_binary, levels_of
from cohortwise.session import stored
from cohortwise.spec import AnalysisError, CohortSpec

CODE = "exposure_code"


@dataclass
class MatchingResult:
    matched: DataFrame
    balance: DataFrame
    report: DataFrame
    outcome_comparison: DataFrame
    mcnemar: DataFrame
    verdict: DataFrame
    reference_level: str
    comparison_level: str


def check_matching_request(exposure: str, covariates, outcome: str) -> list[str]:
    covariates = list(covariates)
    if not covariates:
        raise AnalysisError("matching needs at least one control")
    if len(set(covariates)) != len(covariates):
        raise AnalysisError("a matching control is given twice")
    if exposure in covariates:
        raise AnalysisError("the exposure cannot be a matching control")
    if outcome in covariates:
        raise AnalysisError("the outcome cannot be a matching control")
    return covariates


def match_scored(
    scored: DataFrame, outcome: str, covariates, spec: CohortSpec, key: str,
    per_block: int | None = None,
) -> MatchingResult:
    """Support, caliper, matching, tests and balance for rows that carry a propensity score."""
    return match_on_logit(propensity.add_logit(scored), outcome, covariates, spec, key, per_block)


def match_on_logit(
    scored: DataFrame, outcome: str, covariates, spec: CohortSpec, key: str,
    per_block: int | None = None,
) -> MatchingResult:
    """As ``match_scored``, for rows that also carry the logit to match on."""
    scored = scored.persist()
    before = propensity.support_bounds(scored, CODE).first().asDict()
    propensity.check_group_sizes({0: before["reference_n"], 1: before["comparison_n"]}, "")
    low, high = before["common_support_lower"], before["common_support_upper"]
    inside = propensity.on_support(scored, low, high)
    sizes = propensity.support_bounds(inside, CODE).first().asDict()
    propensity.check_group_sizes(
        {0: sizes["reference_n"], 1: sizes["comparison_n"]}, "on the common support"
    )
    radius = propensity.caliper(scored).first().caliper
    if radius is None or radius != radius:
        raise AnalysisError("the spread of the propensity score cannot be computed")
    pairs = matching.match_rows(inside, CODE, propensity.LOGIT, key, radius, per_block)
    # a pair is stored once, in columns; its two rows with their ids and role are made as they are read
    matched = matching.matched_table(stored(pairs), key)
    matching.require_pairs(matched.filter(F.col("matched_role") == matching.COMPARISON).count())
    table = balance.balance_table(scored, matched, CODE, covariates, spec)
    support = {**sizes, "lower": low, "upper": high, "caliper": radius}
    return MatchingResult(
        matched=matched,
        balance=table,
        report=matching.matching_report(matched, before, support),
        outcome_comparison=matching.matched_rates(matched, outcome),
        mcnemar=matching.mcnemar(matching.pair_outcomes(matched, outcome)),
        verdict=balance.balance_verdict(table),
        reference_level="",
        comparison_level="",
    )


def propensity_matching(
    df: DataFrame, exposure: str, covariates, outcome: str, spec: CohortSpec, key: str
) -> MatchingResult:
    """Score, match and judge. Rows without exposure or outcome are left out; rows without a
    covariate stay and are imputed. ``key`` must be unique."""
    covariates = check_matching_request(exposure, covariates, outcome)
    require_columns(df, [key, exposure, outcome, *covariates], "matching")
    columns = list(dict.fromkeys([key, exposure, outcome, *covariates]))
    rows = df.select(*[col(c) for c in columns]).na.drop(subset=[exposure, outcome])
    rows = propensity.prepare_covariates(rows, covariates, spec).persist()
    validate_binary_outcome(rows, outcome)
    levels = levels_of(rows, [exposure])[exposure]
    if len(levels) != 2:
        raise AnalysisError(f"exposure '{exposure}' must have two levels, found {levels}")
    coded = encode_binary(rows, exposure, CODE)
    sizes = {r[CODE]: r["count"] for r in coded.groupBy(CODE).count().collect()}
    propensity.check_group_sizes(sizes, "")
    scored = propensity.score_propensity(coded, CODE, covariates, spec)
    result = match_scored(scored, outcome, covariates, spec, key)
    result.reference_level, result.comparison_level = levels
    return result
