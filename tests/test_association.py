import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import functions as F

from cohortwise.functions import special
from cohortwise.operators import design, logistic, unadjusted
from cohortwise.plans import association
from cohortwise.spec import AnalysisError, AnalysisRequest, CohortSpec

SPEC = CohortSpec(
    variables={"x": "continuous", "z": "continuous", "sex": "binary", "g": "categorical", "g_b": "binary"},
    target="y",
    key="id",
)


@pytest.fixture(scope="module")
def cohort(spark):
    rng = np.random.default_rng(11)
    n = 800
    x, z = rng.normal(40, 10, n), rng.normal(0, 1, n)
    sex, g, g_b = rng.choice(["F", "M"], n), rng.choice(["a", "b", "c"], n), rng.choice(["no", "yes"], n)
    eta = -3 + 0.05 * x + 0.4 * z + 0.5 * (sex == "M") - 0.6 * (g == "c")
    y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int)
    rows = [
        (str(i), float(x[i]), float(z[i]), str(sex[i]), str(g[i]), str(g_b[i]), int(y[i])) for i in range(n)
    ]
    return spark.createDataFrame(
        rows, "id string, x double, z double, sex string, g string, g_b string, y int"
    ).persist()


def test_special_functions_known_values():
    assert abs(special.normal_two_sided(1.959963984540054) - 0.05) < 1e-12
    assert abs(special.chi2_sf(3.841458820694124, 1) - 0.05) < 1e-10
    assert abs(special.chi2_sf(18.307038053275146, 10) - 0.05) < 1e-10
    assert abs(special.t_two_sided(2.2281388519649385, 10) - 0.05) < 1e-10
    assert abs(special.fisher_two_sided(8, 2, 1, 5) - 0.03496503496503495) < 1e-12
    assert special.binomial_half_two_sided(3, 3) == 1.0
    assert abs(special.binomial_half_two_sided(1, 9) - 0.021484375) < 1e-12


def test_fisher_matches_enumeration():
    rng = np.random.default_rng(1)
    for _ in range(40):
        a, b, c, d = (int(v) for v in rng.integers(0, 25, 4))
        if min(a + b, c + d, a + c, b + d) == 0:
            continue
        row, col, n = a + b, a + c, a + b + c + d
        weights = {k: math.comb(row, k) * math.comb(n - row, col - k) for k in range(max(0, row + col - n), min(row, col) + 1)}
        expected = sum(w for w in weights.values() if w <= weights[a] * (1 + 1e-7)) / sum(weights.values())
        assert abs(special.fisher_two_sided(a, b, c, d) - expected) < 1e-10


def test_two_groups_zero_cell_and_level_errors(spark):
    df = spark.createDataFrame([("a", 0)] * 5 + [("b", 1)] * 3 + [("b", 0)], "g string, y int")
    r = unadjusted.binary_association(df, "g", "y").first()
    assert r.risk_ratio is None and r.reference_level == "a"
    assert abs(r.odds_ratio - (3.5 * 5.5) / (1.5 * 0.5)) < 1e-12
    for bad in (df.filter("g = 'a'"), df.union(spark.createDataFrame([("c", 1)], "g string, y int"))):
        with pytest.raises(PySparkException):
            unadjusted.binary_association(bad, "g", "y").first()


def test_chi_square_corrects_two_levels_only(spark):
    df = spark.createDataFrame(
        [("a", 1)] * 10 + [("a", 0)] * 20 + [("b", 1)] * 30 + [("b", 0)] * 15, "g string, y int"
    )
    r = unadjusted.chi_square(df, "g", "y").first()
    expected = [30 * 40 / 75, 30 * 35 / 75, 45 * 40 / 75, 45 * 35 / 75]
    statistic = sum((abs(o - e) - 0.5) ** 2 / e for o, e in zip([10, 20, 30, 15], expected, strict=True))
    assert abs(r.chi2_statistic - statistic) < 1e-9 and r.degrees_of_freedom == 1


def test_welch_finds_a_gap_and_none(spark):
    gap = [(0, int(i < 4)) for i in range(20)] + [(1, int(i < 16)) for i in range(20)]
    r = unadjusted.welch_test(spark.createDataFrame(gap, "d int, y int"), "d", "y").first()
    assert r.significant and abs(r.mean_difference - 0.6) < 1e-12
    flat = [(g, i % 2) for g in (0, 1) for i in range(20)]
    r = unadjusted.welch_test(spark.createDataFrame(flat, "d int, y int"), "d", "y").first()
    assert not r.significant and abs(r.p_value - 1) < 1e-9


def test_logit_matches_spark_glm_and_score_equations(spark, cohort):
    request = AnalysisRequest("x", ("z", "sex", "g"))
    fit = association.fit_request(cohort, request, SPEC)
    assert fit.method == logistic.STANDARD
    matrix = design.design_matrix(cohort, fit.design, ["y"])
    names = [t.name for t in fit.design.terms]
    ready = VectorAssembler(inputCols=names, outputCol="f").transform(matrix)
    glm = GeneralizedLinearRegression(family="binomial", featuresCol="f", labelCol="y", tol=1e-12).fit(ready)
    assert np.allclose(fit.beta[1:], glm.coefficients.toArray(), atol=1e-7)
    assert np.allclose(np.sqrt(np.diag(fit.covariance))[1:], glm.summary.coefficientStandardErrors[:-1], rtol=1e-5)
    x = np.array([[r[n] for n in names] for r in matrix.collect()])
    y = np.array([r.y for r in matrix.collect()])
    p = 1 / (1 + np.exp(-(fit.beta[0] + x @ fit.beta[1:])))
    assert np.max(np.abs(x.T @ (y - p))) < 1e-5
    margin = logistic.average_margins(fit, [("50", {"x": 50.0})]).first().adjusted_probability
    x[:, names.index("x")] = 50.0
    assert abs(margin - np.mean(1 / (1 + np.exp(-(fit.beta[0] + x @ fit.beta[1:]))))) < 1e-12


def test_control_named_like_an_exposure_level_is_not_an_exposure_term(cohort):
    request = AnalysisRequest("g", ("g_b",))
    found = design.build_design(cohort, request, SPEC)
    assert [t.name for t in found.exposure_terms] == ["g_b", "g_c"]
    assert len(found.terms) == 3


def test_collinear_controls_are_refused(cohort):
    spec = CohortSpec(variables={**SPEC.variables, "x2": "continuous"}, target="y")
    rows = cohort.withColumn("x2", F.col("x") * 2 + 1)
    with pytest.raises(AnalysisError, match="collinear"):
        association.fit_request(rows, AnalysisRequest("x", ("x2",)), spec)


def test_complete_separation_is_refused_and_partial_falls_back(spark, cohort):
    rows = cohort.withColumn("x", F.col("y") * 10.0 + F.col("z") / 100)
    with pytest.raises(AnalysisError, match="cannot be estimated"):
        association.fit_request(rows, AnalysisRequest("x"), SPEC)
    partial = cohort.withColumn("g", F.when((F.col("y") == 1) & (F.col("x") > 45), "z").otherwise(F.col("g")))
    fit = association.fit_request(partial, AnalysisRequest("g"), SPEC)
    effects = {e["term"]: e["estimable"] for e in logistic.exposure_effects(fit)}
    assert fit.method == logistic.FALLBACK and effects == {"g_b": True, "g_c": True, "g_z": False}


def test_constant_exposure_and_single_level_control(cohort):
    with pytest.raises(AnalysisError):
        design.build_design(cohort.withColumn("x", F.lit(1.0)), AnalysisRequest("x"), SPEC)
    found = design.build_design(cohort.withColumn("sex", F.lit("F")), AnalysisRequest("x", ("sex",)), SPEC)
    assert [t.name for t in found.terms] == ["x"]


def test_analyze_each_kind(cohort):
    gaps = cohort.withColumn("z", F.when(F.col("id").cast("int") % 10 != 0, F.col("z")))
    r = association.analyze(gaps, AnalysisRequest("x", ("z",)), SPEC)
    assert (r.input_rows, r.sample_size, r.rows_excluded) == (800, 720, 80)
    assert r.diagnostics["adjustment_applied"] and r.margins.count() == 5 and r.overall_test is None
    r = association.analyze(cohort, AnalysisRequest("g"), SPEC)
    rates = {x.level: x.target_rate for x in r.unadjusted["levels"].collect()}
    margins = {x.exposure_value: x.adjusted_probability for x in r.margins.collect()}
    assert all(abs(rates[k] - margins[k]) < 1e-9 for k in rates)
    assert r.overall_test["degrees_of_freedom"] == 2 and not r.diagnostics["adjustment_applied"]
    r = association.analyze(cohort, AnalysisRequest("sex"), SPEC)
    odds = r.unadjusted["groups"].first().odds_ratio
    assert abs(r.effects.first().odds_ratio - odds) < 1e-8
