"""Queries for splits, schemas, models, explanations, experiments and stored tables."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.catalogue.unadjusted import rounded
from cohortwise.functions.columns import sigmoid
from cohortwise.operators import binning, boosting, explain, features, frames, metrics, splits
from cohortwise.operators.boosting import BoostingParams
from cohortwise.plans import experiments, training
from cohortwise.session import scratch_folder, shared_folder
from cohortwise.sources import artefacts
from cohortwise.sources.tables import RAW_SPEC, TRADE_SPEC, raw_trade_text, trade_cohort

SCORED_FEATURES = ("quantity", "return_flag", "segment")
REPEATS = 10


def linear_score(df: DataFrame) -> DataFrame:
    """A fixed scorer that SQL can repeat."""
    eta = (
        F.lit(-2.0)
        + 0.06 * F.col("quantity")
        + 0.8 * (F.col("return_flag") == "R").cast("double")
        - 0.5 * (F.col("segment") == "BUILDING").cast("double")
    )
    return df.withColumn("probability", F.round(sigmoid(eta), 6))


def _labelled(spark, folder):
    return trade_cohort(spark, folder, ["row_id", "outcome", *TRADE_SPEC.features])


def split(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", "outcome"]).persist()
    return splits.add_split(rows, "outcome", "row_id")


def folds(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", "outcome"]).persist()
    return splits.add_folds(rows, "outcome", "row_id", 5)


def _schema(spark, folder):
    rows = _labelled(spark, folder).persist()
    train, _ = splits.stratified_split(rows, "outcome", "row_id")
    return features.input_schema(train, TRADE_SPEC.features, TRADE_SPEC)


def schema(spark, folder):
    found = features.schema_frame(spark, _schema(spark, folder)).select(
        "feature", "kind", "minimum", "maximum", F.array_join("levels", "|").alias("levels")
    )
    return rounded(found, "minimum", "maximum")


def references(spark, folder):
    found = features.schema_frame(spark, _schema(spark, folder))
    number = F.when(F.col("kind") == "continuous", F.col("reference_value").cast("double"))
    found = found.select(
        "feature", number.alias("median"), "q05", "q95",
        F.when(F.col("kind") != "continuous", F.col("reference_value")).alias("mode"),
    )
    return rounded(found, "median", "q05", "q95", digits=4)


_RUN = "fits"


def _registry(spark):
    """Fits of the queries below, kept in the shared folder: whichever query runs first makes them."""
    return experiments.FitRegistry(f"{shared_folder(spark)}/{_RUN}")


def forget() -> None:
    """Keep fits apart from those made so far, so that the next query trains anew."""
    global _RUN
    _RUN = f"fits-{uuid.uuid4().hex}"


def trained(spark, folder):
    """The evaluation of the model trained on four fifths; its tables are made when they are asked for."""
    return training.evaluate(
        _labelled(spark, folder), TRADE_SPEC, BoostingParams(), importance_repeats=REPEATS, fit=_registry(spark).fit
    )


def _bundle(spark, folder):
    found = trained(spark, folder)
    return training.Bundle(found.model, metrics.DEFAULT_THRESHOLD, found.card)


def boosted_trees(spark, folder):
    """Quality of one uncalibrated tree model, fitted on four fifths, on the fifth held out."""
    table, _ = experiments.prepare(_labelled(spark, folder), TRADE_SPEC)
    trees = _registry(spark).fit(table.where(F.col("fold") != 0), BoostingParams(), "fold-5-without-0")
    held = boosting.with_margin(table.rows.filter("fold = 0"), trees, "margin")
    return metrics.evaluate(held.withColumn("p", sigmoid(F.col("margin"))), "outcome", "p")


def calibrated_model(spark, folder):
    return trained(spark, folder).metrics


def predictions(spark, folder):
    return trained(spark, folder).predictions


def model_importance(spark, folder):
    return trained(spark, folder).importance


def model_fairness(spark, folder):
    return trained(spark, folder).fairness


def card(spark, folder):
    found = trained(spark, folder).card
    return spark.createDataFrame(
        [(k, json.dumps(v)) for k, v in found.items() if k != "generated_at"], "field string, value string"
    )


def score_rows(spark, folder):
    """The stored-threshold scoring operator over the whole cohort with a fixed scorer."""
    scored = linear_score(trade_cohort(spark, folder, ["row_id", *SCORED_FEATURES]))
    return boosting.classify(scored, 0.5).select("row_id", "probability", "predicted_class")


def model_scores(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", *TRADE_SPEC.features])
    return training.predict(rows, _bundle(spark, folder), "row_id").select(
        "row_id", "probability", "predicted_class"
    )


def importance(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", "outcome", *SCORED_FEATURES]).persist()
    found = explain.permutation_importance(
        rows, "outcome", "row_id", SCORED_FEATURES, linear_score, REPEATS
    )
    return rounded(found, "importance_mean", "importance_std")


FIXED_SCHEMA = {
    "quantity": {"kind": "continuous", "minimum": 1.0, "maximum": 50.0, "q05": 3.0, "q95": 48.0,
                 "reference_value": 25.0},
    "return_flag": {"kind": "categorical", "levels": ["A", "N", "R"], "reference_value": "N"},
    "segment": {"kind": "categorical", "reference_value": "MACHINERY",
                "levels": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]},
}


def _records(spark, folder):
    return trade_cohort(spark, folder, ["row_id", *SCORED_FEATURES])


def _impacts(spark, folder):
    return explain.local_impacts(_records(spark, folder), "row_id", FIXED_SCHEMA, linear_score)


def impacts(spark, folder):
    found = _impacts(spark, folder)
    return rounded(found, *[c for c in found.columns if c.endswith(("probability", "points"))])


def top_impacts(spark, folder):
    records = explain.recorded_impacts(_records(spark, folder), "row_id", FIXED_SCHEMA, linear_score)
    found = frames.top_record_impacts(records, "row_id")
    return rounded(
        found.select("row_id", "feature", "position", "impact_percentage_points"),
        "impact_percentage_points",
    )


def explained(spark, folder):
    found = explain.explained_predictions(
        _records(spark, folder), "row_id", FIXED_SCHEMA, linear_score, 0.5, ("low", "high"), "fixed", "-"
    )
    return found.select(
        "row_id", "predicted_class", "predicted_label", "probability",
        F.round(F.col("impacts")[0]["impact_probability"], 6).alias("strongest_impact"),
        F.array_join(F.transform("impacts", lambda e: e["feature"]), ",").alias("features"),
        F.round(F.aggregate("impacts", F.lit(0.0), lambda t, e: t + e["impact_probability"]), 6).alias("impact_sum"),
    )


def model_explained(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", *TRADE_SPEC.features])
    found = training.explain_records(rows, _bundle(spark, folder), "row_id", ("low", "high"))
    return found.drop("trained_at")


def _what_if(spark, folder, feature):
    return explain.what_if(_records(spark, folder), "row_id", feature, FIXED_SCHEMA, linear_score)


def what_if_continuous(spark, folder):
    found = _what_if(spark, folder, "quantity").groupBy(
        F.round(F.col("value").cast("double"), 6).alias("value")
    )
    return rounded(found.agg(F.count("*").alias("n"), F.avg("probability_percent").alias("mean")), "mean")


def what_if_levels(spark, folder):
    return _what_if(spark, folder, "segment").select("row_id", "value", "probability")


def what_if_frame(spark, folder):
    found = frames.what_if_frame(_what_if(spark, folder, "return_flag"), "current_value")
    return found.groupBy("value", "is_current").agg(F.count("*").alias("n"))


def importance_frame(spark, folder):
    rows = trade_cohort(spark, folder, ["row_id", "outcome", *SCORED_FEATURES]).persist()
    found = explain.permutation_importance(
        rows, "outcome", "row_id", SCORED_FEATURES, linear_score, REPEATS
    )
    return rounded(frames.importance_frame(found), "importance_mean", "importance_std")


def cross_validation(spark, folder):
    table, found = experiments.prepare(_labelled(spark, folder), TRADE_SPEC)
    return experiments.fold_scores(table, found, BoostingParams(), fit=_registry(spark).fit)


def _searched(spark, folder):
    """The random search: ranking, refitted best model, its folds, comparison."""
    table, found = experiments.prepare(_labelled(spark, folder), TRADE_SPEC)
    return experiments.search(
        table, found, experiments.sample_parameters(experiments.CANDIDATES), fit=_registry(spark).fit
    )


def search(spark, folder):
    return _searched(spark, folder).ranking


def search_best_folds(spark, folder):
    return _searched(spark, folder).best_folds


def search_comparison(spark, folder):
    return _searched(spark, folder).comparison


def stored_search(spark, folder):
    """The ranking of the stored search, with the number of trees of the stored model."""
    path = scratch_folder(spark)
    experiments.write_search(_searched(spark, folder), path)
    trees = artefacts.read_table(spark, f"{path}/trees", ["tree"]).count() - 1  # the first one is a constant
    return spark.read.parquet(f"{path}/ranking").withColumn("best_trees", F.lit(trees))


def compared_scores(spark, folder):
    """Fold scores of two fixed scorers, compared fold by fold."""
    rows = trade_cohort(spark, folder, ["row_id", "outcome", "score", *SCORED_FEATURES]).persist()
    parted = linear_score(splits.add_folds(rows, "outcome", "row_id", 5)).persist()
    base = metrics.roc_auc(parted, "outcome", "score", ["fold"])
    other = metrics.roc_auc(parted, "outcome", "probability", ["fold"])
    found = experiments.compare_scores(base, other)
    return rounded(found, *[c for c in found.columns if "fold" not in c])


def _oof(spark, folder):
    table, found = experiments.prepare(_labelled(spark, folder), TRADE_SPEC)
    return experiments.out_of_fold(table, found, TRADE_SPEC, BoostingParams(), fit=_registry(spark).fit)


def out_of_fold(spark, folder):
    return _oof(spark, folder)


def calibration_comparison(spark, folder):
    names = {n: f"{n}_probability" for n in ("uncalibrated", "sigmoid", "isotonic")}
    return metrics.probability_metrics(_oof(spark, folder), "y_true", names)


def calibration_curves(spark, folder):
    names = {n: f"{n}_probability" for n in ("uncalibrated", "sigmoid", "isotonic")}
    return binning.reliability_curve(_oof(spark, folder), "y_true", names)


def stored_out_of_fold(spark, folder):
    """Write the out-of-fold predictions, read each variant back, scan thresholds of the stored table."""
    path = scratch_folder(spark)
    artefacts.write_out_of_fold(_oof(spark, folder), path)
    whole = None
    for variant in ("uncalibrated", "sigmoid", "isotonic"):
        p = f"{variant}_probability"
        scan = metrics.threshold_scan(artefacts.read_out_of_fold(spark, path, p), "y_true", p)
        kept = scan.select(
            F.lit(variant).alias("variant"), "threshold", (F.col("tp") + F.col("fn")).alias("positives"),
            (F.col("fp") + F.col("tn")).alias("negatives"), ((F.col("recall") >= 0) & (F.col("recall") <= 1)).alias("valid"),
        )
        whole = kept if whole is None else whole.unionByName(kept)
    return whole


def csv_scan(spark, folder):
    """Write the raw text as CSV, scan it with the column contract, count what was read."""
    path = scratch_folder(spark)
    raw_trade_text(spark, folder).write.csv(path, header=True)
    rows = artefacts.read_raw_csv(spark, path, RAW_SPEC)
    return rows.groupBy(F.trim("segment").alias("segment")).agg(F.count("*").alias("n"))


def csv_profile_rows(spark, folder):
    path = scratch_folder(spark)
    raw_trade_text(spark, folder).write.csv(path, header=True)
    rows = artefacts.load_before_cleaning(spark, path, RAW_SPEC)
    return rows.groupBy("segment", "high_value").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity")
    )


def csv_clean(spark, folder):
    """CSV in, cleaned table out to Parquet, read back."""
    source, path = scratch_folder(spark), scratch_folder(spark)
    raw_trade_text(spark, folder).write.csv(source, header=True)
    artefacts.load_and_clean(spark, source, RAW_SPEC, save_to=path)
    rows = artefacts.read_table(spark, path, ["high_value"])
    return rows.groupBy("segment", "high_value").agg(
        F.count("*").alias("n"), F.sum("quantity").alias("quantity")
    )


def bundle_round_trip(spark, folder):
    """Scores of the stored and reloaded model against the ones before storing."""
    path, found = scratch_folder(spark), trained(spark, folder)
    training.save_evaluation(found, path)
    again = training.load_bundle(spark, path)
    rows = trade_cohort(spark, folder, ["row_id", *TRADE_SPEC.features])
    before = found.model.score(rows).select("row_id", F.col("probability").alias("before"))
    after = again.model.score(rows).select("row_id", F.col("probability").alias("after"))
    gap = F.abs(F.col("before") - F.col("after"))
    return before.join(after, "row_id").agg(F.count("*").alias("n"), F.count_if(gap > 1e-12).alias("changed"))


def stored_side_tables(spark, folder):
    """Ranges and levels of the stored schema, for features that the stored importance also lists."""
    path = scratch_folder(spark)
    training.save_evaluation(trained(spark, folder), path)
    stored, listed = training.read_schema(spark, path), training.read_importance(spark, path)
    found = stored.join(listed.filter("importance_mean is not null").select("feature"), "feature").select(
        "feature", "kind", "minimum", "maximum", F.array_join("levels", "|").alias("levels")
    )
    return rounded(found, "minimum", "maximum")


def stored_diagnostics(spark, folder):
    """Stored metrics must follow from the stored predictions, which are those of the test rows."""
    path = scratch_folder(spark)
    training.save_evaluation(trained(spark, folder), path)
    stored, rows = training.read_diagnostics(spark, path)
    counts = rows.agg(F.count("*").alias("rows"), F.sum("y_test").cast("bigint").alias("positives"))
    return metrics.artefact_consistency(stored, rows).select("metric", "consistent").join(F.broadcast(counts))  # one row


QUERIES = {
    "p2_stratified_split": split,
    "p2_folds": folds,
    "p3_input_schema": schema,
    "p4_references": references,
    "p5_boosted_trees": boosted_trees,
    "p6_calibrated_model": calibrated_model,
    "p8_predictions": predictions,
    "p9_model_recall": model_fairness,
    "p11_permutation_importance": importance,
    "p11_model_importance": model_importance,
    "p12_model_card": card,
    "p14_score_rows": score_rows,
    "p14_model_scores": model_scores,
    "p16_local_impacts": impacts,
    "p17_explained_predictions": explained,
    "p17_model_explained": model_explained,
    "p18_what_if_continuous": what_if_continuous,
    "p18_what_if_levels": what_if_levels,
    "v5_top_impacts": top_impacts,
    "v6_what_if_frame": what_if_frame,
    "v7_importance_frame": importance_frame,
    "x1_cross_validation": cross_validation,
    "x2_random_search": search,
    "x2_best_folds": search_best_folds,
    "x2_comparison": search_comparison,
    "x2_stored_search": stored_search,
    "x3_compared_scores": compared_scores,
    "x4_out_of_fold": out_of_fold,
    "x4_calibration_comparison": calibration_comparison,
    "x6_model_reliability": calibration_curves,
    "s1_csv_scan": csv_scan,
    "s5_csv_profile_rows": csv_profile_rows,
    "s6_csv_clean": csv_clean,
    "s7_bundle_round_trip": bundle_round_trip,
    "s9_side_tables": stored_side_tables,
    "s10_stored_diagnostics": stored_diagnostics,
    "s12_stored_out_of_fold": stored_out_of_fold,
}

_PLACED = """,
placed AS (SELECT *, row_number() OVER (PARTITION BY outcome ORDER BY md5(row_id)) AS rn,
  count(*) OVER (PARTITION BY outcome) AS n FROM cohort)"""
_FOLDED = """,
folded AS (SELECT *, CAST(len(list_filter([1, 2, 3, 4], lambda i: rn > n * i // 5)) AS INTEGER) AS fold FROM placed)"""
_TRAIN = _PLACED + ", train AS (SELECT * FROM placed WHERE rn <= n * 4 // 5)"


def _linear(q: str = "quantity", f: str = "return_flag", s: str = "segment") -> str:
    return f"""round(1 / (1 + exp(-(-2.0::DOUBLE + 0.06::DOUBLE * {q}
      + 0.8::DOUBLE * CAST({f} = 'R' AS INTEGER) - 0.5::DOUBLE * CAST({s} = 'BUILDING' AS INTEGER)))), 6)"""


def _schema_sql(f: str) -> str:
    if TRADE_SPEC.kind(f) == "continuous":
        return f"""SELECT '{f}' AS feature, 'continuous' AS kind, round(min({f}), 6) AS minimum,
          round(max({f}), 6) AS maximum, NULL AS levels FROM train"""
    return f"""SELECT '{f}', '{TRADE_SPEC.kind(f)}', NULL, NULL,
      array_to_string(list_sort(list(DISTINCT {f})), '|') FROM train"""


def _reference_sql(f: str) -> str:
    if TRADE_SPEC.kind(f) == "continuous":
        return f"""SELECT '{f}' AS feature, round(quantile_cont({f}, 0.5)::DOUBLE, 4) AS median,
          round(quantile_cont({f}, 0.05)::DOUBLE, 4) AS q05, round(quantile_cont({f}, 0.95)::DOUBLE, 4) AS q95,
          NULL AS mode FROM train"""
    return f"""SELECT '{f}', NULL, NULL, NULL,
      (SELECT {f} FROM train GROUP BY 1 ORDER BY count(*) DESC, {f} LIMIT 1)"""


_IMPORTANCE = f""",
ordered AS (SELECT *, row_number() OVER (ORDER BY md5(row_id)) - 1 AS place, count(*) OVER () AS size FROM cohort),
halved AS (SELECT place, size, greatest(1, CAST(ceil(log2(size) / 2) AS INTEGER)) AS half FROM ordered),
walked AS (WITH RECURSIVE walk AS (
  SELECT r, place, size, half, CAST(-1 AS BIGINT) AS spot, CAST(place AS BIGINT) AS rest FROM halved, range({REPEATS}) AS t(r)
  UNION ALL SELECT r, place, size, half, (l4 << half) | r4, (l4 << half) | r4 FROM (
    SELECT *, r3 AS l4, xor(l3, ((r3 * k + (k >> 3)) % 4294967296 >> 11) & ((1 << half) - 1)) AS r4
    FROM (SELECT *, r2 AS l3, xor(l2, ((r2 * k3 + (k3 >> 3)) % 4294967296 >> 11) & ((1 << half) - 1)) AS r3,
      (r * {explain.ROUNDS} + 4) * {explain.KEY_STEP} % 4294967296 AS k
    FROM (SELECT *, r1 AS l2, xor(l1, ((r1 * k2 + (k2 >> 3)) % 4294967296 >> 11) & ((1 << half) - 1)) AS r2,
      (r * {explain.ROUNDS} + 3) * {explain.KEY_STEP} % 4294967296 AS k3
    FROM (SELECT *, r0 AS l1, xor(rest >> half, ((r0 * k1 + (k1 >> 3)) % 4294967296 >> 11) & ((1 << half) - 1)) AS r1,
      (r * {explain.ROUNDS} + 2) * {explain.KEY_STEP} % 4294967296 AS k2
    FROM (SELECT *, rest & ((1 << half) - 1) AS r0, (r * {explain.ROUNDS} + 1) * {explain.KEY_STEP} % 4294967296 AS k1
      FROM walk WHERE spot < 0 OR spot >= size)))))
  ) SELECT r, place, spot FROM walk WHERE spot >= 0 AND spot < size),
variants AS (SELECT w.r, f.f AS feature, m.outcome, CASE f.f
    WHEN 'quantity' THEN {_linear('b.quantity', 'm.return_flag', 'm.segment')}
    WHEN 'return_flag' THEN {_linear('m.quantity', 'b.return_flag', 'm.segment')}
    ELSE {_linear('m.quantity', 'm.return_flag', 'b.segment')} END AS p
  FROM walked w JOIN ordered m ON m.place = w.spot JOIN ordered b ON b.place = w.place, (VALUES ('quantity'), ('return_flag'), ('segment')) AS f(f)
  UNION ALL SELECT -1, 'none', outcome, {_linear()} FROM cohort),
aucs AS (SELECT r, feature, sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY r, feature ORDER BY p
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT r, feature, p, sum(outcome) AS pos, sum(1 - outcome) AS neg FROM variants GROUP BY 1, 2, 3))
  GROUP BY 1, 2),
importance AS (SELECT a.feature, avg(b.auc - a.auc) AS importance_mean, stddev_pop(b.auc - a.auc) AS importance_std
  FROM aucs a, aucs b WHERE b.r = -1 AND a.r >= 0 GROUP BY 1)"""
_IMPACTS = f""",
impacts AS (SELECT row_id, f.f AS feature, {_linear()} AS original_probability, CASE f.f
    WHEN 'quantity' THEN {_linear('25.0::DOUBLE', 'return_flag', 'segment')}
    WHEN 'return_flag' THEN {_linear('quantity', "'N'", 'segment')}
    ELSE {_linear('quantity', 'return_flag', "'MACHINERY'")} END AS reference_probability,
    CASE f.f WHEN 'quantity' THEN CAST(quantity AS VARCHAR) WHEN 'return_flag' THEN return_flag ELSE segment END AS current_value,
    CASE f.f WHEN 'quantity' THEN '25.0' WHEN 'return_flag' THEN 'N' ELSE 'MACHINERY' END AS reference_value
  FROM cohort, (VALUES ('quantity'), ('return_flag'), ('segment')) AS f(f))"""

ORACLES = {
    "p2_stratified_split": sql.with_(sql.COHORT + _PLACED)
    + "SELECT row_id, outcome, rn <= n * 4 // 5 AS is_train FROM placed",
    "p2_folds": sql.with_(sql.COHORT + _PLACED + _FOLDED) + "SELECT row_id, outcome, fold FROM folded",
    "p3_input_schema": sql.with_(sql.COHORT + _TRAIN)
    + " UNION ALL ".join(_schema_sql(f) for f in TRADE_SPEC.features),
    "p4_references": sql.with_(sql.COHORT + _TRAIN)
    + " UNION ALL ".join(_reference_sql(f) for f in TRADE_SPEC.features),
    "p11_permutation_importance": sql.with_(sql.COHORT + _IMPORTANCE)
    + """SELECT feature, round(importance_mean, 6) AS importance_mean,
      round(importance_std, 6) AS importance_std FROM importance""",
    "p14_score_rows": sql.with_(sql.COHORT)
    + f"""SELECT row_id, probability, CAST(probability >= 0.5 AS INTEGER) AS predicted_class
      FROM (SELECT row_id, {_linear()} AS probability FROM cohort)""",
    "p16_local_impacts": sql.with_(sql.COHORT + _IMPACTS)
    + """SELECT row_id, feature, current_value, reference_value, original_probability, reference_probability,
      round(original_probability - reference_probability, 6) + 0 AS impact_probability,
      round((original_probability - reference_probability) * 100, 6) + 0 AS impact_percentage_points
      FROM impacts""",
    "p17_explained_predictions": sql.with_(sql.COHORT + _IMPACTS)
    + """SELECT row_id, CAST(p >= 0.5 AS INTEGER) AS predicted_class,
      CASE WHEN p >= 0.5 THEN 'high' ELSE 'low' END AS predicted_label, p AS probability,
      round(strongest, 6) + 0 AS strongest_impact, features, round(total, 6) + 0 AS impact_sum FROM (
      SELECT row_id, any_value(original_probability) AS p,
        arg_min(original_probability - reference_probability,
          (-abs(original_probability - reference_probability), feature)) AS strongest,
        string_agg(feature, ',' ORDER BY -abs(original_probability - reference_probability), feature) AS features,
        sum(original_probability - reference_probability) AS total
      FROM impacts GROUP BY row_id)""",
    "p18_what_if_continuous": sql.with_(sql.COHORT)
    + f"""SELECT round(v, 6) AS value, count(*) AS n, round(avg({_linear('v')} * 100), 6) AS mean
      FROM cohort, (SELECT CASE WHEN i = 14 THEN 48.0::DOUBLE ELSE 3.0::DOUBLE + i * (45.0::DOUBLE / 14) END AS v
                    FROM range(15) AS g(i)) GROUP BY v""",
    "p18_what_if_levels": sql.with_(sql.COHORT)
    + f"""SELECT row_id, v AS value, {_linear(s='v')} AS probability FROM cohort,
      (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY')) AS g(v)""",
    "v5_top_impacts": sql.with_(sql.COHORT + _IMPACTS)
    + """, signed AS (SELECT row_id, feature, (original_probability - reference_probability) * 100 AS i FROM impacts),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY abs(i) DESC, feature) AS k FROM signed)
      SELECT row_id, feature, CAST(row_number() OVER (PARTITION BY row_id ORDER BY i, feature) AS INTEGER) AS position,
        round(i, 6) + 0 AS impact_percentage_points FROM ranked WHERE k <= 8""",
    "v6_what_if_frame": sql.with_(sql.COHORT)
    + """SELECT v AS value, v = return_flag AS is_current, count(*) AS n
      FROM cohort, (VALUES ('A'), ('N'), ('R')) AS g(v) GROUP BY ALL""",
    "v7_importance_frame": sql.with_(sql.COHORT + _IMPORTANCE)
    + """SELECT feature, round(importance_mean, 6) AS importance_mean,
      round(importance_std, 6) AS importance_std FROM importance ORDER BY importance_mean DESC LIMIT 10""",
    "x3_compared_scores": sql.with_(sql.COHORT + _PLACED + _FOLDED)
    + f""", stacked AS (SELECT fold, 'base' AS m, outcome, score AS p FROM folded
        UNION ALL SELECT fold, 'other', outcome, {_linear()} FROM folded),
      aucs AS (SELECT fold, m, sum(pos * (below + neg / 2.0)) / (sum(pos)::DOUBLE * sum(neg)) AS auc FROM (
        SELECT *, coalesce(sum(neg) OVER (PARTITION BY fold, m ORDER BY p
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
        FROM (SELECT fold, m, p, sum(outcome) AS pos, sum(1 - outcome) AS neg FROM stacked GROUP BY 1, 2, 3))
        GROUP BY 1, 2)
      SELECT count(*) AS folds, round(avg(b.auc), 6) AS baseline_mean, round(stddev_samp(b.auc), 6) AS baseline_std,
        round(avg(o.auc), 6) AS candidate_mean, round(stddev_samp(o.auc), 6) AS candidate_std,
        round(avg(o.auc - b.auc), 6) AS mean_difference, count(*) FILTER (WHERE o.auc > b.auc) AS folds_improved
      FROM aucs b JOIN aucs o ON b.fold = o.fold AND b.m = 'base' AND o.m = 'other'""",
    "s1_csv_scan": sql.with_(sql.RAW)
    + "SELECT nullif(trim(segment), '') AS segment, count(*) AS n FROM raw GROUP BY 1",
    "s5_csv_profile_rows": sql.with_(sql.PROFILED)
    + "SELECT segment, high_value, count(*) AS n, sum(quantity) AS quantity FROM profiled GROUP BY ALL",
    "s6_csv_clean": sql.with_(sql.COERCED)
    + f"""SELECT segment, {sql.TARGET} AS high_value, count(*) AS n, sum(quantity) AS quantity
      FROM (SELECT DISTINCT * FROM coerced WHERE {sql.VALID}) GROUP BY ALL""",
    "s7_bundle_round_trip": "SELECT count(*) AS n, 0::BIGINT AS changed FROM lineitem",
    "s12_stored_out_of_fold": sql.with_(sql.COHORT)
    + """SELECT v.v AS variant, round(0.05 + t / 100.0, 2)::DOUBLE AS threshold, count(*) FILTER (WHERE outcome = 1) AS positives,
      count(*) FILTER (WHERE outcome = 0) AS negatives, true AS valid
      FROM cohort, range(91) AS r(t), (VALUES ('uncalibrated'), ('sigmoid'), ('isotonic')) AS v(v) GROUP BY v.v, t""",
    "s9_side_tables": sql.with_(sql.COHORT + _TRAIN) + " UNION ALL ".join(_schema_sql(f) for f in TRADE_SPEC.features),
    "s10_stored_diagnostics": sql.with_(sql.COHORT + _PLACED)
    + """SELECT metric, true AS consistent, n AS rows, positives FROM
      (SELECT count(*) AS n, sum(outcome)::BIGINT AS positives FROM placed WHERE rn > n * 4 // 5),
      (SELECT unnest(['test_rows', 'accuracy', 'precision', 'recall', 'f1', 'roc_auc']) AS metric)""",
}
