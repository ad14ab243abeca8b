"""Queries for design matrices, logistic fits and margins."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.catalogue.unadjusted import rounded
from cohortwise.operators import cleaning, frames, logistic
from cohortwise.operators import design as designs
from cohortwise.plans import association
from cohortwise.sources.tables import RAW_SPEC, TRADE_SPEC, raw_trade_text, trade_cohort
from cohortwise.spec import CATEGORICAL, AnalysisRequest, CohortSpec

ADJUSTED = AnalysisRequest("exposed", ("quantity", "return_flag", "segment"))


def _sample(spark, folder, request, *extra):
    columns = [TRADE_SPEC.target, request.exposure, *request.controls, *extra]
    return cleaning.complete_cases(trade_cohort(spark, folder, columns), columns)


def _fit(spark, folder, request):
    rows = _sample(spark, folder, request).persist()
    return rows, association.fit_request(rows, request, TRADE_SPEC)


def design_matrix(spark, folder):
    request = AnalysisRequest("segment", ("quantity", "line_status", "return_flag"))
    design = designs.build_design(_sample(spark, folder, request).persist(), request, TRADE_SPEC)  # the keys are not kept
    return designs.design_matrix(_sample(spark, folder, request, "row_id"), design, ["row_id"])


def kept_terms(spark, folder):
    """Two of the controls have a single value and must give no term."""
    spec = CohortSpec(
        variables={**TRADE_SPEC.variables, "site": "categorical", "lot": "continuous"},
        target="outcome",
    )
    request = AnalysisRequest("priority", ("site", "lot", "line_status"))
    rows = trade_cohort(spark, folder, ["outcome", "priority", "line_status"])
    rows = rows.withColumn("site", F.lit("main")).withColumn("lot", F.lit(7.0))
    design = designs.build_design(rows, request, spec)
    return spark.createDataFrame(
        [(t.name, t.column == design.exposure) for t in design.terms], "term string, exposure boolean"
    )


def effects_binary(spark, folder):
    _, fit = _fit(spark, folder, AnalysisRequest("exposed"))
    found = logistic.effects_frame(fit).drop("warning")
    return rounded(found, "coefficient", "odds_ratio", "p_value", "ci_95_low", "ci_95_high")


def effects_status(spark, folder):
    _, fit = _fit(spark, folder, AnalysisRequest("line_status"))
    found = logistic.effects_frame(fit).drop("warning")
    return rounded(found, "coefficient", "odds_ratio", "p_value", "ci_95_low", "ci_95_high")


def effects_continuous(spark, folder):
    _, fit = _fit(spark, folder, AnalysisRequest("quantity"))
    found = logistic.effects_frame(fit).drop("warning")
    return rounded(found, "coefficient", "odds_ratio", "p_value", "ci_95_low", "ci_95_high")


def margins_continuous(spark, folder):
    rows, fit = _fit(spark, folder, AnalysisRequest("quantity"))
    found = logistic.average_margins(fit, logistic.margin_grid(rows, fit.design))
    return rounded(
        found.select(F.col("exposure_value").cast("double").alias("exposure_value"), "adjusted_probability"),
        "adjusted_probability",
    )


def score_equations(spark, folder):
    """Sums of x * (y - p) at the adjusted fit, which the maximum makes zero."""
    rows, fit = _fit(spark, folder, ADJUSTED)
    design = fit.design
    eta = F.lit(fit.coefficient(designs.INTERCEPT))
    for term in design.terms:
        eta = eta + fit.coefficient(term.name) * designs.term_value(term, design)
    residual = F.col("outcome") - 1 / (1 + F.exp(-eta))
    sums = rows.agg(
        F.sum(residual).alias("const"),
        *[F.sum(residual * designs.term_value(t, design)).alias(t.name) for t in design.terms],
    )
    return rounded(sums.unpivot([], sums.columns, "term", "score"), "score", digits=4)


def fallback(spark, folder):
    """One level holds positives only: the other levels stay estimable."""
    spec = CohortSpec(variables={"lane": CATEGORICAL}, target="outcome")
    rows = trade_cohort(spark, folder, ["outcome", "quantity", "return_flag"])
    rows = rows.select(
        "outcome",
        F.when((F.col("outcome") == 1) & (F.col("quantity") > 45), "top")
        .otherwise(F.col("return_flag")).alias("lane"),
    ).persist()
    fit = association.fit_request(rows, AnalysisRequest("lane"), spec)
    found = logistic.effects_frame(fit).select(
        F.lit(fit.method).alias("fit_method"), "term", "estimable", "odds_ratio", "ci_95_low", "ci_95_high"
    )
    return rounded(found, "odds_ratio", "ci_95_low", "ci_95_high", digits=4)


def diagnostics(spark, folder):
    rows, fit = _fit(spark, folder, AnalysisRequest("segment"))
    found = spark.createDataFrame([logistic.diagnostics(fit, False)], logistic.DIAGNOSTIC_SCHEMA)
    return rounded(rounded(found, "pseudo_r_squared"), "aic", "bic", digits=4)


def wald(spark, folder):
    _, fit = _fit(spark, folder, AnalysisRequest("segment"))
    found = spark.createDataFrame([logistic.joint_wald(fit)], logistic.WALD_SCHEMA)
    found = found.select("estimable", "statistic", "degrees_of_freedom", "p_value")
    return rounded(found, "statistic", "p_value", digits=4)


def wald_adjusted(spark, folder):
    _, fit = _fit(spark, folder, AnalysisRequest("segment", ("quantity", "return_flag", "balance")))
    return spark.createDataFrame([logistic.joint_wald(fit)], logistic.WALD_SCHEMA)


def margins_levels(spark, folder):
    rows, fit = _fit(spark, folder, AnalysisRequest("segment"))
    found = logistic.average_margins(fit, logistic.margin_grid(rows, fit.design)).drop("position")
    return rounded(found, "adjusted_probability")


def margins_adjusted(spark, folder):
    rows, fit = _fit(spark, folder, AnalysisRequest("balance", ("quantity", "nation", "segment")))
    return logistic.average_margins(fit, logistic.margin_grid(rows, fit.design))


ONE_CONTROL = AnalysisRequest("exposed", ("quantity",))


def one_control(spark, folder):
    """A whole association request with one control: effect, joint test and margins."""
    result = association.analyze(_sample(spark, folder, ONE_CONTROL), ONE_CONTROL, TRADE_SPEC)
    effect = result.effects.select(
        F.lit("effect").alias("section"),
        F.inline(F.array(*[
            F.struct(F.lit(m).alias("item"), F.col(m).cast("double").alias("value"))
            for m in ("coefficient", "odds_ratio", "ci_95_low", "ci_95_high")
        ])),
    )
    found = spark.createDataFrame([logistic.joint_wald(result.fit)], logistic.WALD_SCHEMA)
    wald_ = found.select(F.lit("wald").alias("section"), F.lit("statistic").alias("item"), F.col("statistic").alias("value"))
    margins = result.margins.select(
        F.lit("margin").alias("section"), F.col("exposure_value").alias("item"), F.col("adjusted_probability").alias("value")
    )
    return rounded(effect.unionByName(wald_).unionByName(margins), "value", digits=4)


def margin_grid(spark, folder):
    rows, parts = trade_cohort(spark, folder, ["outcome", "balance", "quantity", "discount"]).persist(), []
    for name in ("balance", "quantity", "discount"):
        design = designs.build_design(rows, AnalysisRequest(name), TRADE_SPEC)
        parts += [(name, float(v)) for v, _ in logistic.margin_grid(rows, design)]
    found = spark.createDataFrame(parts, "exposure string, exposure_value double")
    return rounded(found, "exposure_value", digits=4)


def association_counts(spark, folder):
    rows = cleaning.clean(raw_trade_text(spark, folder), RAW_SPEC)
    request = AnalysisRequest("quantity", ("segment", "return_flag"))
    result = association.analyze(rows, request, RAW_SPEC)
    return spark.createDataFrame(
        [(result.input_rows, result.sample_size, result.rows_excluded,
          result.diagnostics["adjustment_applied"])],
        "input_rows bigint, sample_size bigint, rows_excluded bigint, adjustment_applied boolean",
    )


def association_sections(spark, folder):
    columns = [TRADE_SPEC.target, ADJUSTED.exposure, *ADJUSTED.controls]
    rows = trade_cohort(spark, folder, columns).persist()
    return association.sections(association.analyze(rows, ADJUSTED, TRADE_SPEC), spark)


def association_levels(spark, folder):
    """Without controls every number of a categorical request has a closed form."""
    rows = trade_cohort(spark, folder, ["outcome", "segment"]).persist()
    found = association.sections(
        association.analyze(rows, AnalysisRequest("segment"), TRADE_SPEC), spark
    )
    kept = found.filter(F.col("measure").isin("coefficient", "odds_ratio", "adjusted_probability", "joint_wald"))
    return rounded(kept, "value", digits=4)


def forest(spark, folder):
    _, fit = _fit(spark, folder, AnalysisRequest("segment"))
    found = frames.forest_frame(logistic.effects_frame(fit)).drop("p_value")
    return rounded(found, *found.columns[1:])


def margin_frame(spark, folder):
    rows, fit = _fit(spark, folder, AnalysisRequest("priority"))
    found = frames.margin_frame(logistic.average_margins(fit, logistic.margin_grid(rows, fit.design)))
    return rounded(found.drop("numeric_value"), "probability_percent")


QUERIES = {
    "l1_design_matrix": design_matrix,
    "l2_constant_terms": kept_terms,
    "l4_logit_binary": effects_binary,
    "l4_logit_continuous": effects_continuous,
    "l9_margins_continuous": margins_continuous,
    "l4_score_equations": score_equations,
    "l5_fallback": fallback,
    "l6_effects": effects_status,
    "l7_diagnostics": diagnostics,
    "l8_joint_wald": wald,
    "l8_joint_wald_adjusted": wald_adjusted,
    "l9_margins": margins_levels,
    "l9_margins_adjusted": margins_adjusted,
    "l10_margin_grid": margin_grid,
    "l11_association": association_sections,
    "l11_association_one_control": one_control,
    "l11_association_closed_form": association_levels,
    "l12_association_counts": association_counts,
    "v2_forest_frame": forest,
    "v3_margin_frame": margin_frame,
}

_SEGMENTS = ("BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
_FLAGS = ("N", "R")

# Cells of a level by outcome table, reference level first, with log-odds and their variances.
_LEVELS = """,
levels AS (SELECT {c} AS level, sum(outcome)::DOUBLE AS pos, sum(1 - outcome)::DOUBLE AS neg,
    count(*)::DOUBLE AS n FROM {source} GROUP BY 1),
reference AS (SELECT ln(pos / neg) AS b0, 1 / pos + 1 / neg AS v0, pos AS pos0, neg AS neg0, level AS level0
  FROM levels ORDER BY level LIMIT 1),
effects AS (SELECT level, ln(pos / neg) - b0 AS b, 1 / pos + 1 / neg AS v,
    sqrt(1 / pos + 1 / neg + v0) AS se, v0 FROM levels, reference WHERE level <> level0)"""


def _levels(column: str, source: str = "cohort") -> str:
    return sql.with_(sql.COHORT + _LEVELS.format(c=column, source=source))


_EFFECT = """round(b, 6) AS coefficient, round(exp(b), 6) AS odds_ratio,
  round(exp(b - 1.959963984540054::DOUBLE * se), 6) AS ci_95_low,
  round(exp(b + 1.959963984540054::DOUBLE * se), 6) AS ci_95_high, true AS estimable"""


def _effects_sql(column: str) -> str:
    p = sql.chi2_sf("(b * b / (se * se))", "1")
    return _levels(column) + f"SELECT '{column}' AS term, {_EFFECT}, round({p}, 6) + 0 AS p_value FROM effects"


_WALD = """(SELECT sum(b * b / v) - any_value(v0) * pow(sum(b / v), 2) / (1 + any_value(v0) * sum(1 / v))
  FROM effects)"""


def _grid_sql(name: str) -> str:
    return f"""SELECT DISTINCT '{name}' AS exposure, round(unnest(
      quantile_cont({name}, [0.05, 0.25, 0.5, 0.75, 0.95]))::DOUBLE, 4) AS exposure_value FROM cohort"""


ORACLES = {
    "l1_design_matrix": sql.with_(sql.COHORT)
    + "SELECT row_id, quantity, CAST(line_status = 'O' AS INTEGER)::DOUBLE AS line_status, "
    + ", ".join(f"CAST(segment = '{s}' AS INTEGER)::DOUBLE AS segment_{s}" for s in _SEGMENTS)
    + ", "
    + ", ".join(f"CAST(return_flag = '{s}' AS INTEGER)::DOUBLE AS return_flag_{s}" for s in _FLAGS)
    + " FROM cohort",
    "l2_constant_terms": sql.with_(sql.COHORT)
    + """SELECT DISTINCT 'priority_' || priority AS term, true AS exposure FROM cohort
      WHERE priority <> (SELECT min(priority) FROM cohort)
      UNION ALL SELECT 'line_status', false""",
    "l4_logit_binary": _effects_sql("exposed"),
    "l4_logit_continuous": sql.with_(sql.COHORT + sql.newton("fit", "quantity", "outcome", "cohort"))
    + f"""SELECT 'quantity' AS term, {_EFFECT}, round({sql.chi2_sf('(b * b / (se * se))', '1')}, 6) + 0 AS p_value
      FROM (SELECT b, sqrt(h11 / (h11 * h22 - h12 * h12)) AS se FROM fit WHERE i = 14)""",
    "l9_margins_continuous": sql.with_(sql.COHORT + sql.newton("fit", "quantity", "outcome", "cohort"))
    + """SELECT v AS exposure_value, round(1 / (1 + exp(-(a + b * v))), 6) AS adjusted_probability FROM fit,
      (SELECT DISTINCT unnest(quantile_cont(quantity, [0.05, 0.25, 0.5, 0.75, 0.95]))::DOUBLE AS v FROM cohort)
      WHERE i = 14""",
    "l4_score_equations": "SELECT unnest(['const', 'exposed', 'quantity', "
    + ", ".join(f"'return_flag_{s}'" for s in _FLAGS)
    + ", "
    + ", ".join(f"'segment_{s}'" for s in _SEGMENTS)
    + "]) AS term, 0.0::DOUBLE AS score",
    "l5_fallback": sql.with_(
        sql.COHORT
        + """,
      lanes AS (SELECT outcome, CASE WHEN outcome = 1 AND quantity > 45 THEN 'top' ELSE return_flag END AS lane
        FROM cohort)"""
        + _LEVELS.format(c="lane", source="lanes").replace("ln(pos / neg) - b0", "ln(pos / nullif(neg, 0)) - b0")
        .replace("1 / pos + 1 / neg AS v,", "1 / pos + 1 / nullif(neg, 0) AS v,")
        .replace("sqrt(1 / pos + 1 / neg + v0)", "sqrt(1 / pos + 1 / nullif(neg, 0) + v0)")
    )
    + """SELECT 'binomial_glm_pinv' AS fit_method, 'lane_' || level AS term, b IS NOT NULL AS estimable,
      round(exp(b), 4) AS odds_ratio, round(exp(b - 1.959963984540054::DOUBLE * se), 4) AS ci_95_low,
      round(exp(b + 1.959963984540054::DOUBLE * se), 4) AS ci_95_high FROM effects""",
    "l6_effects": _effects_sql("line_status"),
    "l7_diagnostics": _levels("segment")
    + """, fit AS (SELECT sum(pos * ln(pos / n) + neg * ln(neg / n)) AS llf, count(*) AS k, sum(n) AS n,
        sum(pos) * ln(sum(pos) / sum(n)) + sum(neg) * ln(sum(neg) / sum(n)) AS llf0 FROM levels)
      SELECT 'standard_logit' AS fit_method, true AS converged, n::BIGINT AS n_observations,
        round(1 - llf / llf0, 6) AS pseudo_r_squared, round(2 * k - 2 * llf, 4) AS aic,
        round(k * ln(n) - 2 * llf, 4) AS bic, false AS adjustment_applied FROM fit""",
    "l8_joint_wald": _levels("segment")
    + f"""SELECT true AS estimable, round(w, 4) AS statistic, CAST(k AS INTEGER) AS degrees_of_freedom,
      round({sql.chi2_sf('w', 'k')}, 4) AS p_value
      FROM (SELECT {_WALD} AS w, (SELECT count(*) FROM effects) AS k)""",
    "l9_margins": sql.with_(sql.COHORT)
    + """SELECT segment AS exposure_value, round(avg(outcome), 6) AS adjusted_probability
      FROM cohort GROUP BY 1""",
    "l10_margin_grid": sql.with_(sql.COHORT)
    + " UNION ALL ".join(_grid_sql(n) for n in ("balance", "quantity", "discount")),
    "l11_association_one_control": sql.with_(
        sql.COHORT + sql.newton_two("fit", "(exposed = 'yes')::INTEGER", "quantity", "outcome", "cohort")
    )
    + """, best AS (SELECT * FROM fit WHERE i = 14)
      SELECT 'effect' AS section, 'coefficient' AS item, round(b, 4) AS value FROM best
      UNION ALL SELECT 'effect', 'odds_ratio', round(exp(b), 4) FROM best
      UNION ALL SELECT 'effect', 'ci_95_low', round(exp(b - 1.959963984540054 * sqrt(v)), 4) FROM best
      UNION ALL SELECT 'effect', 'ci_95_high', round(exp(b + 1.959963984540054 * sqrt(v)), 4) FROM best
      UNION ALL SELECT 'wald', 'statistic', round(b * b / v, 4) FROM best
      UNION ALL SELECT 'margin', level, round(sum(n / (1 + exp(-(a + b * e + c * z)))) / sum(n), 4)
        FROM best, fit_patterns, (VALUES ('no', 0), ('yes', 1)) AS l(level, e) GROUP BY level""",
    "l11_association_closed_form": _levels("segment")
    + f"""SELECT 'effects' AS section, 'segment_' || level AS item, 'coefficient' AS measure,
        round(b, 4) AS value FROM effects
      UNION ALL SELECT 'effects', 'segment_' || level, 'odds_ratio', round(exp(b), 4) FROM effects
      UNION ALL SELECT 'margins', level, 'adjusted_probability', round(pos / n, 4) FROM levels
      UNION ALL SELECT 'model', 'all', 'joint_wald', round({_WALD}, 4)""",
    "l12_association_counts": sql.with_(sql.COERCED)
    + f"""SELECT count(*) AS input_rows, count(*) FILTER (WHERE complete) AS sample_size,
      count(*) FILTER (WHERE NOT complete) AS rows_excluded, true AS adjustment_applied
      FROM (SELECT quantity IS NOT NULL AND segment IS NOT NULL AND return_flag IS NOT NULL
              AND price_class IS NOT NULL AS complete FROM (SELECT DISTINCT * FROM coerced WHERE {sql.VALID}))""",
    "v2_forest_frame": _levels("segment")
    + """SELECT 'segment_' || level AS term, round(exp(b), 6) AS odds_ratio, round(lo, 6) AS ci_95_low,
      round(hi, 6) AS ci_95_high, round(hi - exp(b), 6) AS error_plus, round(exp(b) - lo, 6) AS error_minus
      FROM (SELECT *, exp(b - 1.959963984540054::DOUBLE * se) AS lo,
        exp(b + 1.959963984540054::DOUBLE * se) AS hi FROM effects)""",
    "v3_margin_frame": sql.with_(sql.COHORT)
    + """SELECT priority AS exposure_value, round(avg(outcome) * 100, 6) AS probability_percent
      FROM cohort GROUP BY 1""",
}
