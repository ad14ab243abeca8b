"""Queries for unadjusted association (U1-U14) and the frames made from it."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.operators import binning, frames
from cohortwise.operators import unadjusted as ops
from cohortwise.sources.tables import review_cohort, trade_cohort

CATEGORIES = ["return_flag", "segment", "priority", "nation", "line_status", "exposed"]


def rounded(df, *names, digits=6):
    """Round doubles; adding zero removes a negative zero."""
    for name in names:
        df = df.withColumn(name, F.round(name, digits) + 0.0)
    return df


def levels(spark, folder):
    return ops.ordered_levels(trade_cohort(spark, folder, CATEGORIES), CATEGORIES).select(
        "column", F.array_join("levels", "|").alias("levels")
    )


def encoded(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", "line_status"])
    return ops.encode_binary(rows, "line_status", "code").groupBy("line_status", "code").agg(
        F.count("*").alias("n")
    )


def _pair(spark, folder, exposure="exposed"):
    return trade_cohort(spark, folder, [exposure, "outcome"])


def two_groups(spark, folder):
    found = ops.binary_association(_pair(spark, folder), "exposed", "outcome").select(
        "reference_level", "comparison_level", "reference_n", "comparison_n", "reference_rate",
        "comparison_rate", "rate_difference", "risk_ratio",
    )
    return rounded(found, "reference_rate", "comparison_rate", "rate_difference", "risk_ratio")


ODDS = ["odds_ratio", "odds_ratio_ci_95_low", "odds_ratio_ci_95_high"]


def odds(spark, folder):
    found = ops.binary_association(_pair(spark, folder), "exposed", "outcome")
    return rounded(found.select(*ODDS), *ODDS)


def odds_zero_cell(spark, folder):
    """Only rows with a negative score class for one level: an empty cell."""
    rows = _pair(spark, folder).filter("exposed = 'yes' OR outcome = 0")
    found = ops.binary_association(rows, "exposed", "outcome").select("risk_ratio", *ODDS)
    return rounded(found, *ODDS, digits=4)


def effect_size(spark, folder):
    found = ops.binary_association(_pair(spark, folder), "exposed", "outcome")
    return rounded(found.select("cohens_h"), "cohens_h")


def fisher(spark, folder):
    small = ops.binary_association(review_cohort(spark, folder), "toxic", "quality")
    large = ops.binary_association(_pair(spark, folder, "line_status"), "line_status", "outcome")
    both = small.withColumn("cohort", F.lit("review")).unionByName(
        large.withColumn("cohort", F.lit("trade"))
    )
    return rounded(both.select("cohort", "fisher_exact_p_value"), "fisher_exact_p_value")


CONTINUOUS_EXPOSURES = ["quantity", "discount", "balance"]


def correlation(spark, folder):
    rows = trade_cohort(spark, folder, [*CONTINUOUS_EXPOSURES, "outcome"])
    found = ops.point_biserials(rows, CONTINUOUS_EXPOSURES, "outcome")
    whole = rounded(found, "exposure_mean", digits=8)  # means of cents end in exact halves
    return rounded(whole, "correlation", "exposure_std", "p_value")


def bins(spark, folder):
    rows = trade_cohort(spark, folder, ["balance", "quantity", "discount", "outcome"]).persist()
    parts = [
        binning.binned_rates(rows, name, "outcome").withColumn("exposure", F.lit(name))
        for name in ("balance", "quantity", "discount")
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2]).drop("bin")
    return rounded(whole, "exposure_mean", "exposure_min", "exposure_max", "target_rate")


def category_rates(spark, folder):
    found = ops.category_rates(
        trade_cohort(spark, folder, ["segment", "outcome"]), "segment", "outcome"
    )
    return rounded(found.select("level", "n", "target_rate"), "target_rate")


def event_rates(spark, folder):
    from cohortwise.sources.tables import table

    events = table(spark, folder, "events").select(
        "event_type", (F.col("value") > 50).cast("int").alias("large")
    )
    found = ops.category_rates(events, "event_type", "large")
    return rounded(found.select("level", "n", "target_rate"), "target_rate")


def chi_square(spark, folder):
    rows = trade_cohort(spark, folder, ["segment", "priority", "line_status", "outcome"]).persist()
    parts = [
        ops.chi_square(rows, name, "outcome").withColumn("exposure", F.lit(name))
        for name in ("segment", "priority", "line_status")
    ]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return rounded(whole, "chi2_statistic", "minimum_expected_count", "chi2_p_value")


def contingency(spark, folder):
    return ops.contingency(trade_cohort(spark, folder, ["nation", "outcome"]), "nation", "outcome")


def extremes(spark, folder):
    found = ops.extreme_levels(
        trade_cohort(spark, folder, ["nation", "outcome"]), "nation", "outcome"
    )
    return rounded(found, "highest_rate", "lowest_rate")


def verdicts(spark, folder):
    rows = trade_cohort(spark, folder, [*CONTINUOUS_EXPOSURES, "outcome"])
    found = ops.point_biserials(rows, CONTINUOUS_EXPOSURES, "outcome")
    return found.select("exposure", ops.verdict(F.col("p_value"), F.col("correlation")).alias("verdict"))


def welch(spark, folder):
    rows = trade_cohort(spark, folder, ["line_status", "balance"])
    found = ops.welch_test(rows, "line_status", "balance")
    return rounded(
        found, "reference_mean", "comparison_mean", "mean_difference", "t_statistic",
        "degrees_of_freedom", "p_value", digits=4,
    )


def rate_frame(spark, folder):
    found = ops.category_rates(trade_cohort(spark, folder, ["segment", "outcome"]), "segment", "outcome")
    return rounded(frames.rate_frame(found), "rate_percent")


def labelled(spark, folder):
    names = {"AUTOMOBILE": "Cars", "BUILDING": "Construction", "MACHINERY": "Machines"}
    found = ops.category_rates(trade_cohort(spark, folder, ["segment", "outcome"]), "segment", "outcome")
    return frames.with_labels(found.select("level", "n"), "level", names)


QUERIES = {
    "u1_ordered_levels": levels,
    "u2_binary_encoding": encoded,
    "u3_two_groups": two_groups,
    "u4_odds_ratio": odds,
    "u4_odds_ratio_zero_cell": odds_zero_cell,
    "u5_cohens_h": effect_size,
    "u6_fisher_exact": fisher,
    "u7_point_biserial": correlation,
    "u8_binned_rates": bins,
    "u9_category_rates": category_rates,
    "u9_event_rates": event_rates,
    "u10_chi_square": chi_square,
    "u11_contingency": contingency,
    "u12_extreme_levels": extremes,
    "u13_verdict": verdicts,
    "u14_welch": welch,
    "v1_rate_frame": rate_frame,
    "v11_labels": labelled,
}

CELLS = """,
cells AS (SELECT sum(outcome) FILTER (WHERE exposed = 'yes') + {k} AS a,
  count(*) FILTER (WHERE exposed = 'yes' AND outcome = 0) + {k} AS b,
  coalesce(sum(outcome) FILTER (WHERE exposed = 'no'), 0) + {k} AS c,
  count(*) FILTER (WHERE exposed = 'no' AND outcome = 0) + {k} AS d FROM {source})"""


def _cells(shift: str = "0", source: str = "cohort") -> str:
    return sql.with_(sql.COHORT + CELLS.format(k=shift, source=source))


def _odds_sql(digits: int) -> str:
    spread = "1.959963984540054::DOUBLE * sqrt(1.0::DOUBLE / a + 1.0::DOUBLE / b + 1.0::DOUBLE / c + 1.0::DOUBLE / d)"
    ratio = "(a::DOUBLE * d / (b::DOUBLE * c))"
    return f"""round({ratio}, {digits}) AS odds_ratio,
      round(exp(ln({ratio}) - {spread}), {digits}) AS odds_ratio_ci_95_low,
      round(exp(ln({ratio}) + {spread}), {digits}) AS odds_ratio_ci_95_high FROM cells"""


def _fisher_sql(name: str, source: str, exposure: str, outcome: str) -> str:
    return f"""SELECT '{name}' AS cohort, round({sql.fisher_two_sided('a', 'b', 'c', 'd')}, 6)
        AS fisher_exact_p_value FROM (
      SELECT sum({outcome}) FILTER (WHERE {exposure} = hi)::BIGINT AS a,
             count(*) FILTER (WHERE {exposure} = hi AND {outcome} = 0) AS b,
             sum({outcome}) FILTER (WHERE {exposure} = lo)::BIGINT AS c,
             count(*) FILTER (WHERE {exposure} = lo AND {outcome} = 0) AS d
      FROM {source}, (SELECT min({exposure}) AS lo, max({exposure}) AS hi FROM {source}))"""


def _correlation_sql(name: str) -> str:
    return f"""SELECT '{name}' AS exposure, count(*) AS n, corr(outcome, {name}) AS r, avg({name}) AS m,
      stddev_samp({name}) AS s FROM cohort"""


CORRELATIONS = ",\nfound AS (" + " UNION ALL ".join(
    _correlation_sql(n) for n in ("quantity", "discount", "balance")
) + """), tested AS (SELECT *, r * sqrt((n - 2) / (1 - r * r)) AS t, CAST(n - 2 AS DOUBLE) AS dof FROM found)"""


def _bins_sql(name: str) -> str:
    return f"""SELECT '{name}' AS exposure, round(avg({name}), 6) AS exposure_mean,
      round(min({name}), 6) AS exposure_min, round(max({name}), 6) AS exposure_max, count(*) AS n,
      round(avg(outcome), 6) AS target_rate
    FROM (SELECT {name}, outcome, len(list_filter(edges, lambda e: e < {name})) AS bin
          FROM cohort, (SELECT list_distinct(list_transform(range(1, least(10, count(DISTINCT {name}))),
              lambda i: 0::DOUBLE)) AS unused,
            list_distinct(quantile_cont({name}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS inner_edges,
            min({name}) AS lowest FROM cohort),
          LATERAL (SELECT list_filter(inner_edges, lambda e: e > lowest) AS edges))
    GROUP BY bin"""


def _chi_sql(name: str) -> str:
    return f"""SELECT '{name}' AS exposure, k - 1 AS dof,
      sum(pow(CASE WHEN k = 2 THEN abs(seen - e) - least(0.5, abs(seen - e)) ELSE seen - e END, 2) / e) AS x,
      min(e) AS m, count(*) FILTER (WHERE e < 5) AS few
    FROM (SELECT seen, k, level_n::DOUBLE * side_n / total AS e FROM (
      SELECT seen, sum(seen) OVER (PARTITION BY level) AS level_n, sum(seen) OVER (PARTITION BY outcome) AS side_n,
             sum(seen) OVER () AS total, (SELECT count(DISTINCT {name}) FROM cohort) AS k
      FROM (SELECT {name} AS level, outcome, count(*) AS seen FROM cohort GROUP BY 1, 2)))
    GROUP BY k"""


ORACLES = {
    "u1_ordered_levels": sql.with_(sql.COHORT)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", array_to_string(list_sort(list(DISTINCT {c})), '|') AS levels
        FROM cohort""" for c in CATEGORIES
    ),
    "u2_binary_encoding": """SELECT l_linestatus AS line_status,
      CAST(l_linestatus <> (SELECT min(l_linestatus) FROM lineitem) AS INTEGER) AS code, count(*) AS n
      FROM lineitem GROUP BY 1""",
    "u3_two_groups": _cells()
    + """SELECT 'no' AS reference_level, 'yes' AS comparison_level, (c + d)::BIGINT AS reference_n,
      (a + b)::BIGINT AS comparison_n, round(c / (c + d)::DOUBLE, 6) AS reference_rate,
      round(a / (a + b)::DOUBLE, 6) AS comparison_rate,
      round(a / (a + b)::DOUBLE - c / (c + d)::DOUBLE, 6) AS rate_difference,
      round((a / (a + b)::DOUBLE) / (c / (c + d)::DOUBLE), 6) AS risk_ratio FROM cells""",
    "u4_odds_ratio": _cells() + "SELECT " + _odds_sql(6),
    "u4_odds_ratio_zero_cell": _cells("0.5", "(SELECT * FROM cohort WHERE exposed = 'yes' OR outcome = 0)")
    + "SELECT NULL::DOUBLE AS risk_ratio, " + _odds_sql(4),
    "u5_cohens_h": _cells()
    + """SELECT round(2 * asin(sqrt(a / (a + b)::DOUBLE)) - 2 * asin(sqrt(c / (c + d)::DOUBLE)), 6)
      AS cohens_h FROM cells""",
    "u6_fisher_exact": sql.with_(sql.COHORT, sql.REVIEW)
    + _fisher_sql("review", "review", "toxic", "quality")
    + " UNION ALL "
    + _fisher_sql("trade", "cohort", "line_status", "outcome"),
    "u7_point_biserial": sql.with_(sql.COHORT + CORRELATIONS)
    + f"""SELECT exposure, n, round(r, 6) AS correlation, round(m, 8) AS exposure_mean,
      round(s, 6) AS exposure_std, abs(round({sql.t_two_sided('t', 'dof')}, 6)) AS p_value FROM tested""",
    "u8_binned_rates": sql.with_(sql.COHORT)
    + " UNION ALL ".join(_bins_sql(n) for n in ("balance", "quantity", "discount")),
    "u9_category_rates": sql.with_(sql.COHORT)
    + """SELECT segment AS level, count(*) AS n, round(avg(outcome), 6) AS target_rate
      FROM cohort GROUP BY 1""",
    "u9_event_rates": """SELECT event_type AS level, count(*) AS n,
      round(avg(CAST(value > 50 AS INTEGER)), 6) AS target_rate FROM events GROUP BY 1""",
    "u10_chi_square": sql.with_(sql.COHORT)
    + f"""SELECT exposure, round(x, 6) AS chi2_statistic, dof AS degrees_of_freedom,
      round(m, 6) AS minimum_expected_count, few AS expected_cells_under_5,
      round({sql.chi2_sf('x', 'dof')}, 6) AS chi2_p_value FROM ("""
    + " UNION ALL ".join(_chi_sql(n) for n in ("segment", "priority", "line_status"))
    + ")",
    "u11_contingency": sql.with_(sql.COHORT)
    + """SELECT nation AS level, count(*) FILTER (WHERE outcome = 0) AS low,
      count(*) FILTER (WHERE outcome = 1) AS high FROM cohort GROUP BY 1""",
    "u12_extreme_levels": sql.with_(sql.COHORT)
    + """, rates AS (SELECT nation, avg(outcome) AS r FROM cohort GROUP BY 1)
      SELECT (SELECT nation FROM rates ORDER BY r DESC, nation LIMIT 1) AS highest_level,
        (SELECT nation FROM rates ORDER BY r, nation LIMIT 1) AS lowest_level,
        round(max(r), 6) AS highest_rate, round(min(r), 6) AS lowest_rate FROM rates""",
    "u13_verdict": sql.with_(sql.COHORT + CORRELATIONS)
    + f"""SELECT exposure, CASE WHEN p < 0.05 AND r > 0 THEN 'positive' WHEN p < 0.05 AND r < 0
      THEN 'negative' ELSE 'none' END AS verdict
      FROM (SELECT *, {sql.t_two_sided('t', 'dof')} AS p FROM tested)""",
    "u14_welch": sql.with_(sql.COHORT)
    + f""", g AS (SELECT line_status AS l, count(*)::DOUBLE AS n, avg(balance) AS m, var_samp(balance) AS v
        FROM cohort GROUP BY 1),
      w AS (SELECT a.l AS la, b.l AS lb, a.n AS na, b.n AS nb, a.m AS ma, b.m AS mb,
        (b.m - a.m) / sqrt(a.v / a.n + b.v / b.n) AS t,
        pow(a.v / a.n + b.v / b.n, 2) / (pow(a.v / a.n, 2) / (a.n - 1) + pow(b.v / b.n, 2) / (b.n - 1)) AS dof
        FROM g a JOIN g b ON a.l < b.l),
      tested AS (SELECT *, {sql.t_two_sided('t', 'dof')} AS p FROM w)
      SELECT la AS reference_level, lb AS comparison_level, na::BIGINT AS reference_n,
        nb::BIGINT AS comparison_n, round(ma, 4) AS reference_mean, round(mb, 4) AS comparison_mean,
        round(mb - ma, 4) AS mean_difference, round(t, 4) AS t_statistic,
        round(dof, 4) AS degrees_of_freedom, round(p, 4) AS p_value, p < 0.05 AS significant FROM tested""",
    "v1_rate_frame": sql.with_(sql.COHORT)
    + """SELECT segment AS level, count(*) AS sample_size, round(avg(outcome) * 100, 6) AS rate_percent
      FROM cohort GROUP BY 1""",
    "v11_labels": sql.with_(sql.COHORT)
    + """SELECT level, n, coalesce(label, level) AS label FROM
      (SELECT segment AS level, count(*) AS n FROM cohort GROUP BY 1) LEFT JOIN
      (VALUES ('AUTOMOBILE', 'Cars'), ('BUILDING', 'Construction'), ('MACHINERY', 'Machines'))
        AS names(code, label) ON level = code""",
}
