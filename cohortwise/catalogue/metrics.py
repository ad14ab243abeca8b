"""Queries for metrics, thresholds, calibration curves and group recall."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.catalogue.unadjusted import rounded
from cohortwise.operators import binning, fairness, frames, metrics
from cohortwise.sources.tables import trade_cohort

MODELS = {"plain": "score", "squared": "squared", "flat": "flat"}


def _scored(spark, folder):
    return trade_cohort(spark, folder, ["outcome", "score"])


def _variants(spark, folder):
    """Three probability columns of different calibration."""
    return _scored(spark, folder).select(
        "outcome",
        "score",
        (F.col("score") * F.col("score")).alias("squared"),
        (F.lit(0.2) + 0.5 * F.col("score")).alias("flat"),
    )


def evaluation(spark, folder):
    found = metrics.evaluate(_scored(spark, folder), "outcome", "score")
    return rounded(found, *[c for c in found.columns if c != "test_rows"])


def auc_by_status(spark, folder):
    """One segment is null: rows without a group are a group."""
    rows = trade_cohort(spark, folder, ["segment", "outcome", "score"])
    rows = rows.withColumn("segment", F.when(F.col("segment") != "BUILDING", F.col("segment")))
    return rounded(metrics.roc_auc(rows, "outcome", "score", ["segment"]), "roc_auc")


def variants(spark, folder):
    found = metrics.probability_metrics(_variants(spark, folder).persist(), "outcome", MODELS)
    return rounded(found, *found.columns[1:])


def comparison(spark, folder):
    found = metrics.change_against(
        metrics.probability_metrics(_variants(spark, folder).persist(), "outcome", MODELS), "plain"
    )
    return rounded(found, *found.columns[1:])


def reliability(spark, folder):
    found = binning.reliability_curve(
        _variants(spark, folder).persist(), "outcome", {"plain": "score", "squared": "squared"}
    )
    return rounded(found, *found.columns[2:])


def _scan(spark, folder):
    return metrics.threshold_scan(_scored(spark, folder), "outcome", "score")


def scan(spark, folder):
    found = _scan(spark, folder)
    return rounded(found, *metrics.SCAN_METRICS, "predicted_positive_rate")


def selection(spark, folder):
    found = metrics.select_thresholds(_scan(spark, folder))
    return rounded(found, *metrics.SCAN_METRICS, "predicted_positive_rate")


def deltas(spark, folder):
    found = metrics.threshold_deltas(metrics.select_thresholds(_scan(spark, folder)))
    return rounded(found, *found.columns[1:])


def roc(spark, folder):
    found = metrics.roc_points(_scored(spark, folder), "outcome", "score")
    return rounded(found, "fpr", "tpr")


def confusion(spark, folder):
    return metrics.confusion_matrix(
        trade_cohort(spark, folder, ["outcome", "predicted"]), "outcome", "predicted"
    )


def consistency(spark, folder):
    rows = trade_cohort(spark, folder, ["outcome", "predicted", "score"]).toDF(
        "y_test", "y_pred", "y_proba"
    ).persist()
    stored = metrics.evaluate(rows, "y_test", "y_proba").withColumn(
        "precision", F.col("precision") + 0.25
    )
    found = metrics.artefact_consistency(stored, rows)
    return rounded(found, "stored", "recomputed")


def _groups(spark, folder):
    rows = trade_cohort(spark, folder, ["outcome", "predicted", "segment", "return_flag", "nation"])
    return fairness.group_recall(rows, "outcome", "predicted", ["segment", "return_flag", "nation"])


def recall_by_group(spark, folder):
    return rounded(_groups(spark, folder), "recall", "false_negative_rate")


def violations(spark, folder):
    return rounded(fairness.fairness_violations(_groups(spark, folder)), "value")


def status(spark, folder):
    return fairness.fairness_status(_groups(spark, folder))


def probabilities(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", "score"])
    return rounded(frames.probability_record(rows, "score"), "probability_percent")


QUERIES = {
    "p7_evaluation": evaluation,
    "p7_auc_by_group": auc_by_status,
    "p9_group_recall": recall_by_group,
    "p10_fairness_violations": violations,
    "p10_fairness_status": status,
    "x5_probability_metrics": variants,
    "x6_reliability_curve": reliability,
    "x7_variant_changes": comparison,
    "x8_threshold_scan": scan,
    "x9_threshold_selection": selection,
    "x10_threshold_deltas": deltas,
    "v8_roc_points": roc,
    "v9_confusion_matrix": confusion,
    "v10_artefact_consistency": consistency,
    "v12_probability_record": probabilities,
}


def _probability_sql(p: str) -> str:
    safe = f"least(greatest({p}, 2.220446049250313e-16::DOUBLE), 1 - 2.220446049250313e-16::DOUBLE)"
    return f"""round(avg(({p} - outcome) * ({p} - outcome)), 6) AS brier_score,
      round(avg(-(outcome * ln({safe}) + (1 - outcome) * ln(1 - {safe}))), 6) AS log_loss,
      round(avg(outcome), 6) AS actual_positive_rate, round(avg({p}), 6) AS mean_predicted_probability,
      round(avg({p}) - avg(outcome), 6) AS mean_probability_bias"""


def _auc_sql(source: str, p: str, group: str = "1") -> str:
    """Mid-rank form of the area, from distinct scores."""
    return f"""SELECT g, sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (
      SELECT g, pos, neg, coalesce(sum(neg) OVER (PARTITION BY g ORDER BY s
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
      FROM (SELECT {group} AS g, {p} AS s, sum(outcome) AS pos, sum(1 - outcome) AS neg
            FROM {source} GROUP BY 1, 2)) GROUP BY g"""


_COUNTS = """count(*) FILTER (WHERE outcome = 1 AND {h}) AS tp,
  count(*) FILTER (WHERE outcome = 0 AND {h}) AS fp,
  count(*) FILTER (WHERE outcome = 1 AND NOT {h}) AS fn,
  count(*) FILTER (WHERE outcome = 0 AND NOT {h}) AS tn"""

_SCAN = (
    """,
scan AS (SELECT threshold, tp, fp, fn, tn, (tp + tn) / n AS accuracy,
    CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp)::DOUBLE END AS precision,
    tp / (tp + fn)::DOUBLE AS recall, tn / (tn + fp)::DOUBLE AS specificity,
    (tp / (tp + fn)::DOUBLE + tn / (tn + fp)::DOUBLE) / 2 AS balanced_accuracy,
    2 * tp / (2 * tp + fp + fn)::DOUBLE AS f1, (tp + fp) / n AS predicted_positive_rate
  FROM (SELECT round(0.05 + t / 100.0, 2)::DOUBLE AS threshold, count(*)::DOUBLE AS n, """
    + _COUNTS.format(h="(score >= round(0.05 + t / 100.0, 2)::DOUBLE)")
    + """ FROM cohort, range(91) AS r(t) GROUP BY 1)),
picked AS (
  SELECT 'default' AS selection, * FROM scan WHERE threshold = 0.5
  UNION ALL SELECT 'best_f1', * FROM (SELECT * FROM scan ORDER BY f1 DESC, threshold LIMIT 1)
  UNION ALL SELECT 'best_balanced_accuracy', *
    FROM (SELECT * FROM scan ORDER BY balanced_accuracy DESC, threshold LIMIT 1)
  UNION ALL SELECT 'closest_precision_recall', *
    FROM (SELECT * FROM scan ORDER BY abs(precision - recall), threshold LIMIT 1))"""
)
_SCAN_COLUMNS = "threshold, " + ", ".join(
    f"round({m}, 6) AS {m}" for m in (*metrics.SCAN_METRICS, "predicted_positive_rate")
) + ", tn, fp, fn, tp"

_VARIANTS = """,
variants AS (
  SELECT 'plain' AS model, outcome, score AS p FROM cohort
  UNION ALL SELECT 'squared', outcome, score * score FROM cohort
  UNION ALL SELECT 'flat', outcome, 0.2::DOUBLE + 0.5::DOUBLE * score FROM cohort)"""

_VARIANT_METRICS = _VARIANTS + f""",
aucs AS ({_auc_sql('variants', 'p', 'model')}),
judged AS (SELECT model, any_value(auc) AS roc_auc, avg((p - outcome) * (p - outcome)) AS brier_score,
  avg(-(outcome * ln(least(greatest(p, 2.220446049250313e-16::DOUBLE), 1 - 2.220446049250313e-16::DOUBLE))
    + (1 - outcome) * ln(1 - least(greatest(p, 2.220446049250313e-16::DOUBLE), 1 - 2.220446049250313e-16::DOUBLE))))
    AS log_loss, avg(outcome) AS actual_positive_rate, avg(p) AS mean_predicted_probability,
  avg(p) - avg(outcome) AS mean_probability_bias
  FROM variants JOIN aucs ON model = g GROUP BY model)"""

_GROUPS = """,
stacked AS (SELECT 'segment' AS group_column, segment AS group_value, outcome, predicted FROM cohort
  UNION ALL SELECT 'return_flag', return_flag, outcome, predicted FROM cohort
  UNION ALL SELECT 'nation', nation, outcome, predicted FROM cohort),
recalls AS (SELECT group_column, group_value, count(*) AS n,
  count(*) FILTER (WHERE outcome = 1) AS n_actual_positive,
  count(*) FILTER (WHERE outcome = 1 AND predicted = 1) / count(*) FILTER (WHERE outcome = 1)::DOUBLE AS recall
  FROM stacked GROUP BY 1, 2 HAVING count(*) FILTER (WHERE outcome = 1) > 0),
spread AS (SELECT group_column, min(recall) AS lo, max(recall) AS hi,
  arg_min(group_value, (recall, group_value)) AS lo_value,
  arg_min(group_value, (-recall, group_value)) AS hi_value
  FROM recalls WHERE n_actual_positive >= 30 GROUP BY 1),
violations AS (
  SELECT group_column, 'min_recall' AS type, lo AS value, 0.6::DOUBLE AS threshold,
    lo_value AS lowest_group_value, hi_value AS highest_group_value FROM spread WHERE lo < 0.6
  UNION ALL SELECT group_column, 'recall_gap', hi - lo, 0.1::DOUBLE, lo_value, hi_value
  FROM spread WHERE hi - lo > 0.1)"""

_DELTAS = ", ".join(
    f"round(p.{m} - d.{m}, 6) AS {m}_change"
    for m in ("threshold", "accuracy", "precision", "recall", "f1")
)

ORACLES = {
    "p7_evaluation": sql.with_(sql.COHORT)
    + f""", auc AS ({_auc_sql('cohort', 'score')}),
      c AS (SELECT {_COUNTS.format(h='(score >= 0.5)')}, count(*) AS test_rows, {_probability_sql('score')} FROM cohort)
      SELECT test_rows, round((tp + tn) / test_rows::DOUBLE, 6) AS accuracy,
        round(tp / (tp + fp)::DOUBLE, 6) AS precision, round(tp / (tp + fn)::DOUBLE, 6) AS recall,
        round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1, round(auc, 6) AS roc_auc, brier_score, log_loss,
        actual_positive_rate, mean_predicted_probability, mean_probability_bias FROM c, auc""",
    "p7_auc_by_group": sql.with_(sql.COHORT)
    + f"SELECT g AS segment, round(auc, 6) AS roc_auc FROM ({_auc_sql('cohort', 'score', "nullif(segment, 'BUILDING')")})",
    "p9_group_recall": sql.with_(sql.COHORT + _GROUPS)
    + """SELECT group_column, group_value, n, n_actual_positive, round(recall, 6) AS recall,
      round(1 - recall, 6) AS false_negative_rate, n_actual_positive >= 30 AS reliable FROM recalls""",
    "p10_fairness_violations": sql.with_(sql.COHORT + _GROUPS)
    + """SELECT group_column, type, round(value, 6) AS value, threshold, lowest_group_value,
      highest_group_value FROM violations""",
    "p10_fairness_status": sql.with_(sql.COHORT + _GROUPS)
    + """SELECT CASE WHEN r = 0 THEN 'skipped' WHEN v > 0 THEN 'fail' ELSE 'pass' END AS status,
      r AS reliable_groups, v AS violations
      FROM (SELECT (SELECT count(*) FROM recalls WHERE n_actual_positive >= 30) AS r,
                   (SELECT count(*) FROM violations) AS v)""",
    "x5_probability_metrics": sql.with_(sql.COHORT + _VARIANT_METRICS)
    + """SELECT model, round(roc_auc, 6) AS roc_auc, round(brier_score, 6) AS brier_score,
      round(log_loss, 6) AS log_loss, round(actual_positive_rate, 6) AS actual_positive_rate,
      round(mean_predicted_probability, 6) AS mean_predicted_probability,
      round(mean_probability_bias, 6) AS mean_probability_bias FROM judged""",
    "x6_reliability_curve": sql.with_(sql.COHORT + _VARIANTS)
    + """, edges AS (SELECT model, quantile_cont(p, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e
        FROM variants WHERE model <> 'flat' GROUP BY 1),
      binned AS (SELECT model, p, outcome, len(list_filter(e, lambda x: x < p)) AS b
        FROM variants JOIN edges USING (model))
      SELECT model, CAST(row_number() OVER (PARTITION BY model ORDER BY b) AS INTEGER) AS bin,
        round(avg(p), 6) AS mean_predicted_probability, round(avg(outcome), 6) AS observed_positive_rate,
        round(avg(p) - avg(outcome), 6) AS calibration_gap FROM binned GROUP BY model, b""",
    "x7_variant_changes": sql.with_(sql.COHORT + _VARIANT_METRICS)
    + """SELECT j.model, round(j.brier_score - b.brier_score, 6) AS brier_score_change,
      round(j.log_loss - b.log_loss, 6) AS log_loss_change, round(j.roc_auc - b.roc_auc, 6) + 0 AS roc_auc_change
      FROM judged j, judged b WHERE b.model = 'plain' AND j.model <> 'plain'""",
    "x8_threshold_scan": sql.with_(sql.COHORT + _SCAN) + f"SELECT {_SCAN_COLUMNS} FROM scan",
    "x9_threshold_selection": sql.with_(sql.COHORT + _SCAN)
    + f"SELECT selection, {_SCAN_COLUMNS} FROM picked",
    "x10_threshold_deltas": sql.with_(sql.COHORT + _SCAN)
    + f"""SELECT p.selection, {_DELTAS} FROM picked p, picked d
      WHERE d.selection = 'default' AND p.selection <> 'default'""",
    "v8_roc_points": sql.with_(sql.COHORT)
    + """, s AS (SELECT score, sum(outcome) AS pos, sum(1 - outcome) AS neg FROM cohort GROUP BY 1)
      SELECT score AS threshold,
        round(sum(neg) OVER (ORDER BY score DESC) / (SELECT sum(neg) FROM s)::DOUBLE, 6) AS fpr,
        round(sum(pos) OVER (ORDER BY score DESC) / (SELECT sum(pos) FROM s)::DOUBLE, 6) AS tpr FROM s
      UNION ALL SELECT 'infinity'::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE""",
    "v9_confusion_matrix": sql.with_(sql.COHORT)
    + """SELECT a AS actual, p AS predicted,
      (SELECT count(*) FROM cohort WHERE outcome = a AND predicted = p) AS n
      FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(a, p)""",
    "v10_artefact_consistency": sql.with_(sql.COHORT)
    + f""", auc AS ({_auc_sql('cohort', 'score')}),
      c AS (SELECT {_COUNTS.format(h='(predicted = 1)')}, count(*)::DOUBLE AS n FROM cohort),
      m AS (SELECT unnest([{{'metric': 'test_rows', 'v': n}}, {{'metric': 'accuracy', 'v': (tp + tn) / n}},
        {{'metric': 'precision', 'v': tp / (tp + fp)::DOUBLE}}, {{'metric': 'recall', 'v': tp / (tp + fn)::DOUBLE}},
        {{'metric': 'f1', 'v': 2 * tp / (2 * tp + fp + fn)::DOUBLE}}, {{'metric': 'roc_auc', 'v': auc}}]) AS x
        FROM c, auc)
      SELECT x.metric AS metric, round(x.v + CASE x.metric WHEN 'precision' THEN 0.25 ELSE 0 END, 6) AS stored,
        round(x.v, 6) AS recomputed, x.metric <> 'precision' AS consistent FROM m""",
    "v12_probability_record": sql.with_(sql.COHORT)
    + "SELECT row_id, score, round(score * 100, 6) AS probability_percent FROM cohort",
}
