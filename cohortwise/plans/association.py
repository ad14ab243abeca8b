"""One association request from validation to matching."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.operators import binning, cleaning, logistic, unadjusted
from cohortwise.operators.design import build_design
from cohortwise.spec import BINARY, CATEGORICAL, CONTINUOUS, AnalysisError, AnalysisRequest, CohortSpec


@dataclass
class AssociationResult:
    """Result tables of one request; every table is a handful of rows."""

    request: AnalysisRequest
    kind: str
    input_rows: int
    sample_size: int
    unadjusted: dict[str, DataFrame]
    effects: DataFrame
    diagnostics: dict
    margins: DataFrame
    overall_test: dict | None
    warnings: list[str] = field(default_factory=list)
    matching: object | None = None
    fit: logistic.LogisticFit | None = None

    @property
    def rows_excluded(self) -> int:
        return self.input_rows - self.sample_size


def unadjusted_tables(df: DataFrame, exposure: str, kind: str, target: str) -> dict[str, DataFrame]:
    """The comparison that fits the kind of the exposure."""
    if kind == BINARY:
        return {"groups": unadjusted.binary_association(df, exposure, target)}
    if kind == CONTINUOUS:
        return {
            "correlation": unadjusted.point_biserial(df, exposure, target),
            "bins": binning.binned_rates(df, exposure, target),
        }
    return {
        "levels": unadjusted.category_rates(df, exposure, target),
        "chi_square": unadjusted.chi_square(df, exposure, target),
    }


def fit_request(df: DataFrame, request: AnalysisRequest, spec: CohortSpec) -> logistic.LogisticFit:
    """Design and fit over rows that are already complete cases."""
    return logistic.fit_logistic(df, build_design(df, request, spec), spec.target)


def analyze(
    df: DataFrame, request: AnalysisRequest, spec: CohortSpec, key: str | None = None
) -> AssociationResult:
    """Unadjusted comparison, logistic adjustment, margins and optional matching.

    Only complete cases of the requested columns take part. These columns alone are persisted, once, because
    every later step reads them again; ``df`` is read once. Matching needs ``key``, a unique row identifier; it
    defaults to the spec's key.
    """
    cleaning.validate_request(df, request, spec)
    columns = [spec.target, request.exposure, *request.controls]
    key = key or spec.key
    if request.include_psm:
        cleaning.require_columns(df, [key], "matching")
        columns.append(key)
    kept = df.select(*[col(c) for c in dict.fromkeys(columns)]).persist()
    input_rows = kept.count()
    sample = cleaning.complete_cases(kept, columns)
    size = sample.count()
    if size == 0:
        raise AnalysisError("no rows are left without missing values")
    cleaning.validate_binary_outcome(sample, spec.target)
    kind = spec.kind(request.exposure)
    simple = unadjusted_tables(sample, request.exposure, kind, spec.target)

    fit = fit_request(sample, request, spec)
    margins = logistic.average_margins(fit, logistic.margin_grid(sample, fit.design))
    matching = None
    if request.include_psm:
        from cohortwise.plans.matching import propensity_matching

        matching = propensity_matching(
            sample, request.exposure, request.controls, spec.target, spec, key
        )
    return AssociationResult(
        request=request,
        kind=kind,
        input_rows=input_rows,
        sample_size=size,
        unadjusted=simple,
        effects=logistic.effects_frame(fit),
        diagnostics=logistic.diagnostics(fit, bool(request.controls)),
        margins=margins,
        overall_test=logistic.joint_wald(fit) if kind == CATEGORICAL else None,
        warnings=fit.warnings,
        matching=matching,
        fit=fit,
    )


def sections(result: AssociationResult, spark) -> DataFrame:
    """The main numbers of a result as one long table: section, item, measure, value."""
    parts = []

    def add(section: str, df: DataFrame, item: str | None, measures: list[str]) -> None:
        entries = [
            F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
            for m in measures
        ]
        label = F.col(item) if item else F.lit("all")
        parts.append(
            df.select(F.lit(section).alias("section"), label.cast("string").alias("item"),
                      F.explode(F.array(*entries)).alias("e")).select("section", "item", "e.*")
        )

    add("effects", result.effects, "term", ["coefficient", "odds_ratio", "p_value", "ci_95_low", "ci_95_high"])
    add("margins", result.margins, "exposure_value", ["adjusted_probability"])
    counts = {
        "input_rows": float(result.input_rows),
        "sample_size": float(result.sample_size),
        "rows_excluded": float(result.rows_excluded),
        **{k: result.diagnostics[k] for k in ("pseudo_r_squared", "aic", "bic")},
    }
    if result.overall_test is not None and result.overall_test["estimable"]:
        counts["joint_wald"] = result.overall_test["statistic"]
        counts["joint_wald_p_value"] = result.overall_test["p_value"]
    parts.append(
        spark.createDataFrame(
            [("model", "all", k, float(v)) for k, v in counts.items()],
            "section string, item string, measure string, value double",
        )
    )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
