"""Queries for propensity-score matching and balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.catalogue.unadjusted import rounded
from cohortwise.functions.columns import hash_uniform, sigmoid
from cohortwise.operators import frames, matching, propensity
from cohortwise.operators.unadjusted import encode_binary
from cohortwise.plans import association
from cohortwise.plans import matching as plans
from cohortwise.sources.tables import TRADE_SPEC, trade_cohort
from cohortwise.spec import AnalysisRequest

COVARIATES = ("quantity", "return_flag", "segment")
NEIGHBOURS = matching.CANDIDATES
HOLED = ("quantity", "balance", "segment")


def _coded(spark, folder, *columns):
    rows = trade_cohort(spark, folder, ["row_id", "exposed", *columns])
    return rows.withColumn(plans.CODE, (F.col("exposed") == "yes").cast("int"))


def _planted(spark, folder, *columns):
    """The cohort with its known propensity, spread by a hash so that support binds."""
    rows = _coded(spark, folder, *dict.fromkeys(["quantity", *columns]))
    spread = 2.0 * (hash_uniform(F.col("row_id"), "p") - 0.5) + 0.5 * F.col(plans.CODE)
    return rows.withColumn(propensity.SCORE, sigmoid(0.05 * (F.col("quantity") - 25) + spread))


def _holes(spark, folder):
    """Covariates with gaps, as direct calls of the matcher may get them."""
    return _with_holes(_coded(spark, folder, "quantity", "balance", "segment", "outcome"))


def _with_holes(rows, *kept):
    return rows.select(
        "row_id", "exposed", plans.CODE, "outcome", *kept,
        F.when(F.substring("row_id", 1, 1) != "a", F.col("quantity").cast("string")).alias("quantity"),
        F.when(F.substring("row_id", 1, 1) != "b", F.col("balance")).alias("balance"),
        F.when(F.substring("row_id", 1, 1) != "c", F.col("segment")).alias("segment"),
    )


def prepared(spark, folder):
    rows = propensity.prepare_covariates(_holes(spark, folder), list(HOLED), TRADE_SPEC)
    return rows.groupBy("quantity", "balance", "segment").agg(F.count("*").alias("n"))


def features(spark, folder):
    rows = propensity.prepare_covariates(
        _holes(spark, folder), list(HOLED), TRADE_SPEC
    ).persist()
    plan = propensity.plan_features(rows, list(HOLED), TRADE_SPEC)
    found = propensity.propensity_features(rows, plan, ["row_id"])
    return rounded(found, "quantity", "balance", digits=4)


def propensity_model(spark, folder):
    """Fitted score per quantity, the only covariate."""
    rows = _coded(spark, folder, "quantity").persist()
    scored = propensity.score_propensity(rows, plans.CODE, ["quantity"], TRADE_SPEC)
    found = scored.groupBy("quantity").agg(
        F.count("*").alias("n"), F.avg(propensity.SCORE).alias("mean_score")
    )
    return rounded(found, "mean_score", digits=5)


def propensity_gradient(spark, folder):
    """At the penalised optimum of the intercept the mean score is the share of comparisons."""
    rows = _coded(spark, folder, *COVARIATES).persist()
    scored = propensity.score_propensity(rows, plans.CODE, COVARIATES, TRADE_SPEC)
    found = scored.agg(F.count("*").alias("n"), F.avg(propensity.SCORE).alias("mean_score"))
    return rounded(found, "mean_score", digits=5)


def groups(spark, folder):
    found = propensity.group_sizes(_planted(spark, folder), plans.CODE)
    return rounded(found, "lowest", "highest")


def support(spark, folder):
    found = propensity.support_bounds(_planted(spark, folder), plans.CODE)
    return rounded(found, "common_support_lower", "common_support_upper")


def caliper(spark, folder):
    found = propensity.caliper(propensity.add_logit(_planted(spark, folder)))
    return rounded(found, "caliper")


def candidates(spark, folder):
    """Nearest references per score, on a score whose distances are exact binary fractions."""
    rows = _coded(spark, folder, "quantity").withColumn("logit", (F.col("quantity") - 25) * 0.0625)
    found = matching.nearest_references(rows.persist(), plans.CODE, "logit", "row_id", NEIGHBOURS)
    return found.drop("reference")


def _exact_score(spark, folder, *columns):
    rows = _coded(spark, folder, "quantity", "return_flag", "outcome", *columns)
    flag = F.when(F.col("return_flag") == "A", 0.0).when(F.col("return_flag") == "N", 0.25).otherwise(0.5)
    return rows.withColumn("logit", (F.col("quantity") - 25) * 0.0625 + flag)


def greedy(spark, folder):
    """Pairs per comparison score and distance, over all rows."""
    rows = _exact_score(spark, folder).persist()
    pairs = matching.match_rows(rows, plans.CODE, "logit", "row_id", 0.25)
    return pairs.groupBy(F.col("comparison.logit").alias("logit"), "distance").agg(
        F.count("*").alias("pairs"), F.count_distinct("reference.row_id").alias("references")
    )


def greedy_uniqueness(spark, folder):
    """Every comparison and reference is used at most once and within the caliper."""
    rows = _exact_score(spark, folder).persist()
    pairs = matching.match_rows(rows, plans.CODE, "logit", "row_id", 0.25)
    flat = pairs.select(
        F.col("comparison.row_id").alias("a"), F.col("reference.row_id").alias("b"), "distance",
        F.col("comparison.exposed").alias("ca"), F.col("reference.exposed").alias("cb"),
    )
    return flat.agg(
        (F.count("*") - F.count_distinct("a")).alias("repeated_comparisons"),
        (F.count("*") - F.count_distinct("b")).alias("repeated_references"),
        F.count_if(F.col("distance") > 0.25).alias("beyond_caliper"),
        F.count_if((F.col("ca") != "yes") | (F.col("cb") != "no")).alias("wrong_roles"),
    )


def _matched(spark, folder):
    """The matching of the whole cohort on an exact score: support, caliper, pairs, tests, balance of columns with gaps."""
    return plans.match_on_logit(_scored_holes(spark, folder), "outcome", list(HOLED), TRADE_SPEC, "row_id")


def _scored_holes(spark, folder):
    """The score is made of the whole columns of the row that then gets its gaps: one cohort, no join with another."""
    score = [F.col("logit").alias(name) for name in (propensity.LOGIT, propensity.SCORE)]
    rows = _with_holes(_exact_score(spark, folder, "balance", "segment"), *score)
    return propensity.prepare_covariates(rows, list(HOLED), TRADE_SPEC)


def long_table(spark, folder):
    return _matched(spark, folder).matched.select(
        "source_index", "pair_id", "matched_role", "match_distance", "segment", "outcome"
    )


def pivoted(spark, folder):
    return matching.pair_outcomes(_matched(spark, folder).matched, "outcome")


def mcnemar(spark, folder):
    return rounded(_matched(spark, folder).mcnemar, "mcnemar_p_value")


def matched_rates(spark, folder):
    found = _matched(spark, folder).outcome_comparison
    return rounded(found, *found.columns)


def report(spark, folder):
    return rounded(_matched(spark, folder).report, "comparison_retention_rate", "mean_match_distance", "caliper")


def balance_table(spark, folder):
    return rounded(_matched(spark, folder).balance, "smd_before", "smd_after")


def balance_verdict(spark, folder):
    return rounded(_matched(spark, folder).verdict, "max_smd_before", "max_smd_after")


def love_plot(spark, folder):
    found = frames.love_frame(_matched(spark, folder).balance)
    return rounded(found, "smd_before", "smd_after", "max_smd")


def full_matching(spark, folder):
    """Propensity model, matching and balance of the planted confounder."""
    rows = trade_cohort(spark, folder, ["row_id", "exposed", "outcome", *COVARIATES])
    result = plans.propensity_matching(rows, "exposed", COVARIATES, "outcome", TRADE_SPEC, "row_id")
    return result.report.join(F.broadcast(result.outcome_comparison)).join(F.broadcast(result.verdict))


def associated_matching(spark, folder):
    """The matching section of an association request."""
    rows = trade_cohort(spark, folder, ["row_id", "line_status", "outcome", "quantity", "return_flag"])
    request = AnalysisRequest("line_status", ("quantity", "return_flag"), include_psm=True)
    result = association.analyze(rows.persist(), request, TRADE_SPEC)
    return result.matching.balance


def encoded_levels(spark, folder):
    rows = encode_binary(trade_cohort(spark, folder, ["row_id", "exposed"]), "exposed", "code")
    return rows.groupBy("exposed", "code").agg(F.count("*").alias("n"))


QUERIES = {
    "m1_binary_codes": encoded_levels,
    "m2_prepared_covariates": prepared,
    "m3_propensity_features": features,
    "m4_propensity_model": propensity_model,
    "m4_propensity_mean": propensity_gradient,
    "m5_group_sizes": groups,
    "m6_common_support": support,
    "m7_caliper": caliper,
    "m8_nearest_references": candidates,
    "m9_greedy_matching": greedy,
    "m9_greedy_uniqueness": greedy_uniqueness,
    "m10_matched_table": long_table,
    "m11_pair_outcomes": pivoted,
    "m12_mcnemar": mcnemar,
    "m13_matched_rates": matched_rates,
    "m14_matching_report": report,
    "m15_balance_table": balance_table,
    "m18_balance_verdict": balance_verdict,
    "m19_propensity_matching": full_matching,
    "m19_association_matching": associated_matching,
    "v4_love_frame": love_plot,
}

_CODED = """,
coded AS (SELECT *, CAST(exposed = 'yes' AS INTEGER) AS code FROM cohort)"""
_PLANTED = _CODED + f""",
planted AS (SELECT *, 1 / (1 + exp(-(0.05::DOUBLE * (quantity - 25)
  + (2.0::DOUBLE * ({sql.uniform('p')} - 0.5) + 0.5::DOUBLE * code)))) AS p FROM coded)"""
_HOLES = _CODED + """,
holes AS (SELECT row_id, code, outcome, CASE WHEN substr(row_id, 1, 1) <> 'a' THEN quantity END AS quantity,
  CASE WHEN substr(row_id, 1, 1) <> 'b' THEN balance END AS balance,
  CASE WHEN substr(row_id, 1, 1) <> 'c' THEN segment END AS segment FROM coded)"""
_SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY", "__MISSING__")

# One step per comparison score, hardest first: it takes from the references left, nearest first.
_SCORE = """(quantity - 25) * 0.0625::DOUBLE
    + CASE return_flag WHEN 'A' THEN 0 WHEN 'N' THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END"""


def _greedy(source: str, radius: str) -> str:
    """The matching of ``source`` (``x``, ``code``) within ``radius``."""
    return f""",
cells AS (SELECT x, sum(code)::BIGINT AS demand, sum(1 - code)::BIGINT AS supply FROM {source} GROUP BY 1),
offered AS (SELECT list(x ORDER BY x) AS offers, list(supply ORDER BY x) AS room FROM cells WHERE supply > 0),
choosers AS (SELECT x, demand, list_min(list_transform(offers, lambda o: abs(o - x))) AS hardness
  FROM cells, offered WHERE demand > 0),
queued AS (SELECT x, demand, row_number() OVER (ORDER BY hardness DESC, x) AS k FROM choosers WHERE hardness <= {radius}),
wishes AS (SELECT k, any_value(x) AS x, any_value(demand) AS demand, list(p ORDER BY d, p) AS prefs
  FROM (SELECT k, x, demand, unnest(range(1, len(offers) + 1)) AS p,
          unnest(list_transform(offers, lambda o: abs(o - x))) AS d FROM queued, offered)
  WHERE d <= {radius} GROUP BY k),
walk(k, x, prefs, takes, remaining) AS (
  SELECT 0::BIGINT, NULL::DOUBLE, NULL::BIGINT[], NULL::BIGINT[], room FROM offered
  UNION ALL
  SELECT k2, x2, prefs2, takes2, list_transform(range(1, len(remaining) + 1), lambda j:
    remaining[j] - coalesce(takes2[list_position(prefs2, j)], 0))
  FROM (SELECT v.k AS k2, v.x AS x2, v.prefs AS prefs2, w.remaining,
      list_transform(range(1, len(v.prefs) + 1), lambda i: greatest(0, least(w.remaining[v.prefs[i]],
        v.demand - coalesce(list_sum(list_transform(v.prefs[1:i - 1], lambda q: w.remaining[q])), 0)))::BIGINT) AS takes2
    FROM walk w JOIN wishes v ON v.k = w.k + 1))"""



_GREEDY = f""",
scored AS (SELECT *, {_SCORE} AS x FROM coded)""" + _greedy("scored", "0.25")

def _smd(name: str, value: str, source: str) -> str:
    return f"""SELECT '{name}' AS covariate, abs(avg({value}) FILTER (WHERE code = 1) - avg({value}) FILTER (WHERE code = 0))
      / sqrt((var_samp({value}) FILTER (WHERE code = 1) + var_samp({value}) FILTER (WHERE code = 0)) / 2) AS smd
      FROM {source}"""


def _smds(source: str) -> str:
    parts = [("quantity", "quantity"), ("balance", "balance")]
    parts += [(f"{c}__missing", f"CAST({c} IS NULL AS INTEGER)") for c in ("quantity", "balance")]
    parts += [
        (f"segment_{s}", f"CAST(coalesce(segment, '__MISSING__') = '{s}' AS INTEGER)") for s in _SEGMENTS
    ]
    return " UNION ALL ".join(_smd(n, v, source) for n, v in parts)


_PAIRS = _CODED + f""",
scored AS (SELECT row_id, code, outcome, CASE WHEN substr(row_id, 1, 1) <> 'a' THEN quantity END AS quantity,
  CASE WHEN substr(row_id, 1, 1) <> 'b' THEN balance END AS balance,
  CASE WHEN substr(row_id, 1, 1) <> 'c' THEN segment END AS segment, {_SCORE} AS x FROM coded),
bounds AS (SELECT max(low) AS low, min(high) AS high FROM (SELECT code, min(x) AS low, max(x) AS high FROM scored GROUP BY code)),
inside AS (SELECT scored.* FROM scored, bounds WHERE x BETWEEN low AND high),
spread AS (SELECT greatest(0.2 * stddev_samp(x), 1e-12) AS radius FROM scored)""" + _greedy("inside", "(SELECT radius FROM spread)") + """,
flows AS (SELECT x, offers[p] AS reference, t AS units FROM (
  SELECT w.x, offers, unnest(w.prefs) AS p, unnest(w.takes) AS t FROM walk w, offered WHERE w.k > 0) WHERE t > 0),
started AS (SELECT *, coalesce(sum(units) OVER (PARTITION BY x ORDER BY reference ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS x_start,
  coalesce(sum(units) OVER (PARTITION BY reference ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reference_start FROM flows),
placed AS (SELECT *, row_number() OVER (PARTITION BY x, code ORDER BY md5(row_id)) - 1 AS place FROM inside),
pairs AS (SELECT a.row_id AS pair_id, a.row_id AS a_id, b.row_id AS b_id, a.outcome AS comparison, b.outcome AS reference,
  a.segment AS a_segment, b.segment AS b_segment, abs(a.x - b.x) AS distance
  FROM started s JOIN placed a ON a.code = 1 AND a.x = s.x AND a.place >= s.x_start AND a.place < s.x_start + s.units
  JOIN placed b ON b.code = 0 AND b.x = s.reference AND b.place = s.reference_start + a.place - s.x_start),
kept AS (SELECT scored.* FROM scored WHERE row_id IN (SELECT a_id FROM pairs UNION ALL SELECT b_id FROM pairs))"""
_BALANCE = _PAIRS + f""",
balance AS (SELECT covariate, b.smd AS smd_before, a.smd AS smd_after
  FROM ({_smds('scored')}) b JOIN ({_smds('kept')}) a USING (covariate))"""

ORACLES = {
    "m1_binary_codes": sql.with_(sql.COHORT + _CODED)
    + "SELECT exposed, code, count(*) AS n FROM coded GROUP BY ALL",
    "m2_prepared_covariates": sql.with_(sql.COHORT + _HOLES)
    + "SELECT quantity, balance, segment, count(*) AS n FROM holes GROUP BY ALL",
    "m3_propensity_features": sql.with_(sql.COHORT + _HOLES)
    + """, m AS (SELECT median(quantity) AS mq, median(balance) AS mb FROM holes),
      filled AS (SELECT row_id, coalesce(quantity, mq) AS q, coalesce(balance, mb) AS b,
        coalesce(segment, '__MISSING__') AS s FROM holes, m)
      SELECT row_id, round((q - (SELECT avg(q) FROM filled)) / (SELECT stddev_pop(q) FROM filled), 4) + 0 AS quantity,
        round((b - (SELECT avg(b) FROM filled)) / (SELECT stddev_pop(b) FROM filled), 4) + 0 AS balance, """
    + ", ".join(f"CAST(s = '{s}' AS INTEGER)::DOUBLE AS segment_{s}" for s in _SEGMENTS)
    + " FROM filled",
    "m4_propensity_model": sql.with_(
        sql.COHORT + _CODED
        + """,
      scale AS (SELECT avg(quantity) AS m, stddev_pop(quantity) AS sd FROM coded),
      scaled AS (SELECT (quantity - m) / sd AS z, quantity, code FROM coded, scale)"""
        + sql.newton("fit", "z", "code", "scaled", "1")
    )
    + """SELECT quantity, count(*) AS n, round(avg(1 / (1 + exp(-(a + b * z)))), 5) AS mean_score
      FROM scaled, fit WHERE i = 14 GROUP BY 1""",
    "m9_greedy_matching": sql.with_(sql.COHORT + _CODED + _GREEDY)
    + """SELECT x AS logit, abs(x - offers[p]) AS distance, sum(t)::BIGINT AS pairs, sum(t)::BIGINT AS "references"
      FROM (SELECT w.x, offers, unnest(w.prefs) AS p, unnest(w.takes) AS t FROM walk w, offered WHERE w.k > 0)
      WHERE t > 0 GROUP BY ALL""",
    "m4_propensity_mean": sql.with_(sql.COHORT + _CODED)
    + "SELECT count(*) AS n, round(avg(code), 5) AS mean_score FROM coded",
    "m5_group_sizes": sql.with_(sql.COHORT + _PLANTED)
    + "SELECT code, count(*) AS n, round(min(p), 6) AS lowest, round(max(p), 6) AS highest FROM planted GROUP BY 1",
    "m6_common_support": sql.with_(sql.COHORT + _PLANTED)
    + """SELECT round(max(lo), 6) AS common_support_lower, round(min(hi), 6) AS common_support_upper,
      max(n) FILTER (WHERE code = 1) AS comparison_n, max(n) FILTER (WHERE code = 0) AS reference_n
      FROM (SELECT code, min(p) AS lo, max(p) AS hi, count(*) AS n FROM planted GROUP BY 1)""",
    "m7_caliper": sql.with_(sql.COHORT + _PLANTED)
    + "SELECT round(greatest(0.2 * stddev_samp(ln(p / (1 - p))), 1e-12), 6) AS caliper FROM planted",
    "m8_nearest_references": sql.with_(sql.COHORT + _CODED)
    + f""", r AS (SELECT row_id, (quantity - 25) * 0.0625::DOUBLE AS l FROM coded WHERE code = 0),
      placed AS (SELECT *, row_number() OVER (ORDER BY l, md5(row_id)) AS place FROM r),
      c AS (SELECT DISTINCT (quantity - 25) * 0.0625::DOUBLE AS x FROM coded WHERE code = 1),
      ranked AS (SELECT x, row_id AS reference_id, abs(l - x) AS distance,
        row_number() OVER (PARTITION BY x ORDER BY abs(l - x), l >= x,
          CASE WHEN l < x THEN -place ELSE place END) AS rank FROM c, placed)
      SELECT x, rank, reference_id, distance FROM ranked WHERE rank <= {NEIGHBOURS}""",
    "m9_greedy_uniqueness": """SELECT 0::BIGINT AS repeated_comparisons, 0::BIGINT AS repeated_references,
      0::BIGINT AS beyond_caliper, 0::BIGINT AS wrong_roles""",
    "m10_matched_table": sql.with_(sql.COHORT + _PAIRS)
    + """SELECT a_id AS source_index, pair_id, 'comparison' AS matched_role, distance AS match_distance,
        a_segment AS segment, comparison AS outcome FROM pairs
      UNION ALL SELECT b_id, pair_id, 'reference', distance, b_segment, reference FROM pairs""",
    "m11_pair_outcomes": sql.with_(sql.COHORT + _PAIRS) + "SELECT pair_id, comparison, reference FROM pairs",
    "m12_mcnemar": sql.with_(sql.COHORT + _PAIRS)
    + """, d AS (SELECT count(*) FILTER (WHERE comparison = 1 AND reference = 0) AS b,
        count(*) FILTER (WHERE comparison = 0 AND reference = 1) AS c FROM pairs)
      SELECT b AS comparison_only_positive_pairs, c AS reference_only_positive_pairs,
        least(b, c)::DOUBLE AS mcnemar_statistic,
        round(least(1, 2 * list_sum(list_transform(range(0, least(b, c) + 1), lambda k:
          exp(lgamma(b + c + 1) - lgamma(k + 1) - lgamma(b + c - k + 1) - (b + c) * ln(2))))), 6)
        AS mcnemar_p_value FROM d""",
    "m13_matched_rates": sql.with_(sql.COHORT + _PAIRS)
    + """SELECT round(avg(reference), 6) AS reference_rate, round(avg(comparison), 6) AS comparison_rate,
      round(avg(comparison) - avg(reference), 6) AS matched_rate_difference FROM pairs""",
    "m14_matching_report": sql.with_(sql.COHORT + _PAIRS)
    + """, sizes AS (SELECT sum(code)::BIGINT AS a, sum(1 - code)::BIGINT AS b FROM scored),
      within AS (SELECT sum(code)::BIGINT AS ai, sum(1 - code)::BIGINT AS bi FROM inside)
      SELECT count(*) AS matched_pairs, any_value(a) AS comparison_before_common_support,
      any_value(b) AS reference_before_common_support, any_value(ai) AS comparison_in_common_support,
      any_value(bi) AS reference_in_common_support, round(count(*) / any_value(a)::DOUBLE, 6) AS comparison_retention_rate,
      any_value(low) AS common_support_lower, any_value(high) AS common_support_upper, round(any_value(radius), 6) AS caliper,
      round(avg(distance), 6) AS mean_match_distance FROM pairs, sizes, within, bounds, spread""",
    "m15_balance_table": sql.with_(sql.COHORT + _BALANCE)
    + "SELECT covariate, round(smd_before, 6) AS smd_before, round(smd_after, 6) AS smd_after FROM balance",
    "m18_balance_verdict": sql.with_(sql.COHORT + _BALANCE)
    + """SELECT 0.1::DOUBLE AS threshold, round(max(smd_before), 6) AS max_smd_before,
      round(max(smd_after), 6) AS max_smd_after,
      count(*) FILTER (WHERE smd_before >= 0.1) AS imbalanced_covariates_before,
      count(*) FILTER (WHERE smd_after >= 0.1) AS imbalanced_covariates_after,
      bool_and(smd_after < 0.1) AS balanced_under_threshold FROM balance""",
    "v4_love_frame": sql.with_(sql.COHORT + _BALANCE)
    + """SELECT covariate, round(smd_before, 6) AS smd_before, round(smd_after, 6) AS smd_after,
      round(greatest(smd_before, smd_after), 6) AS max_smd FROM balance
      ORDER BY greatest(smd_before, smd_after) DESC LIMIT 20""",
}
