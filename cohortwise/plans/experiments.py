"""Cross-validation, randomised search and calibration comparison."""

from __future__ import annotations

import hashlib
import json
import random
from dataclasses import asdict, dataclass, replace

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, sigmoid
from cohortwise.operators import boosting, features, splits
from cohortwise.operators.boosting import BoostingParams, FitTable
from cohortwise.operators.metrics import roc_auc
from cohortwise.operators.trees import TREE_SCHEMA, TreeModel
from cohortwise.plans.training import bins_frame, trees_frame
from cohortwise.session import scratch_folder
from cohortwise.spec import CohortSpec

CV_FOLDS = 5
CANDIDATES = 40
INNER_FOLDS = 3
# The searched ranges.
SEARCH_SPACE = {
    "learning_rate": ("log_uniform", 0.03, 0.25),
    "max_iter": ("integer", 100, 350),
    "max_depth": ("choice", [None, 3, 5, 7, 9]),
    "max_leaf_nodes": ("choice", [15, 31, 63, None]),
    "min_rows_per_leaf": ("integer", 10, 50),
    "l2": ("uniform", 0.0, 2.0),
}


class FitRegistry:
    """Fitted models in the shared folder, by table, parameters and name of the fit.

    A model is written as soon as its fit ends, so a run that lost its driver goes on where it was, and
    runs that need the same fit (cross-validation, search, out-of-fold prediction) make it once.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def path(self, table: FitTable, params: BoostingParams, name: str) -> str:
        described = json.dumps([asdict(params), name, table.fingerprint, asdict(table.bins)], sort_keys=True)
        return f"{self.folder}/{hashlib.sha256(described.encode()).hexdigest()[:32]}"

    def fit(self, table: FitTable, params: BoostingParams, name: str) -> TreeModel:
        spark, path = table.rows.sparkSession, self.path(table, params, name)
        try:
            rows = spark.read.schema(TREE_SCHEMA).parquet(path).collect()
        except AnalysisException:
            rows = []
        if len(rows) == params.max_iter + 1:
            return TreeModel.from_rows(table.bins, rows)
        model = boosting.fit_tree(table, params)
        spark.createDataFrame(model.rows(), TREE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
        return model


def _new(table: FitTable, params: BoostingParams, name: str) -> TreeModel:
    return boosting.fit_tree(table, params)


def prepare(df: DataFrame, spec: CohortSpec, folds: int = CV_FOLDS) -> tuple[FitTable, dict]:
    """The table that fits read, with its outer folds, and the schema of the features."""
    # Schema, class sizes and fold bounds each read the rows.
    df = df.select(col(spec.key), col(spec.target), *[col(f) for f in spec.features]).persist()
    schema = features.input_schema(df, spec.features, spec)
    parted = splits.add_folds(df, spec.target, spec.key, folds, "fold")
    table = boosting.whole_table(parted, schema, spec.target, spec.key, ("fold",))
    df.unpersist()
    return table, schema


def _fold_models(table: FitTable, params: BoostingParams, folds: int, fit) -> list[TreeModel]:
    return boosting.in_parallel(
        lambda k: fit(table.where(F.col("fold") != k), params, f"fold-{folds}-without-{k}"), list(range(folds))
    )


def _held_out(table: FitTable, models: list[TreeModel]) -> DataFrame:
    """Fold, label and margin of every row, by the model that was not fitted on it."""
    whole = None
    for k, model in enumerate(models):
        part = boosting.with_margin(table.rows.filter(F.col("fold") == k), model, "margin").select("fold", boosting.LABEL, "margin")
        whole = part if whole is None else whole.unionByName(part)
    return whole


def fold_scores(
    table: FitTable, schema: dict, params: BoostingParams, folds: int = CV_FOLDS, fit=_new
) -> DataFrame:
    """Exact ROC-AUC on each held-out fold."""
    models = _fold_models(table, params, folds, fit)
    found = roc_auc(_held_out(table, models), boosting.LABEL, "margin", ["fold"]).collect()
    return table.rows.sparkSession.createDataFrame(sorted((r.fold, r.roc_auc) for r in found), "fold int, roc_auc double")


def score_summary(scores: DataFrame) -> DataFrame:
    """Mean and sample deviation over the folds."""
    return scores.agg(
        F.avg("roc_auc").alias("roc_auc_mean"), F.stddev_samp("roc_auc").alias("roc_auc_std")
    )


def sample_parameters(count: int, space: dict | None = None, seed: int = boosting.SEED) -> list[BoostingParams]:
    """Draw parameter sets from the space, the same ones for the same seed."""
    draw = random.Random(seed)
    found = []
    for _ in range(count):
        values = {}
        for name, (kind, *bounds) in (space or SEARCH_SPACE).items():
            if kind == "log_uniform":
                low, high = bounds
                values[name] = low * (high / low) ** draw.random()
            elif kind == "uniform":
                low, high = bounds
                values[name] = low + (high - low) * draw.random()
            elif kind == "integer":
                values[name] = draw.randint(*bounds)
            else:
                values[name] = draw.choice(bounds[0])
        found.append(BoostingParams(**values))
    return found


RANKING_SCHEMA = (
    "candidate int, learning_rate double, max_iter int, max_depth int, max_leaf_nodes int, min_rows_per_leaf int, "
    "l2 double, mean_score double, std_score double, rank int"
)


@dataclass
class SearchResult:
    """The ranking of all candidates; the best one, refitted on all rows, against the current parameters."""

    ranking: DataFrame
    best: BoostingParams
    model: TreeModel
    best_folds: DataFrame
    comparison: DataFrame


def random_search(
    table: FitTable, schema: dict, candidates: list[BoostingParams], folds: int = CV_FOLDS, fit=_new
) -> DataFrame:
    """Cross-validated ROC-AUC of every candidate, ranked."""
    places = [(p, k) for p in candidates for k in range(folds)]
    fitted = boosting.in_parallel(
        lambda place: fit(table.where(F.col("fold") != place[1]), place[0], f"fold-{folds}-without-{place[1]}"), places
    )

    def judged(i: int) -> list[float]:
        held = _held_out(table, fitted[i * folds : (i + 1) * folds])
        return [r.roc_auc for r in roc_auc(held, boosting.LABEL, "margin", ["fold"]).collect()]

    scores = boosting.in_parallel(judged, list(range(len(candidates))))
    means = [float(np.mean(s)) for s in scores]
    order = sorted(range(len(candidates)), key=lambda i: (-means[i], i))
    rows = [
        (
            i, p.learning_rate, p.max_iter, p.max_depth, p.max_leaf_nodes, p.min_rows_per_leaf, float(p.l2),
            means[i], float(np.std(scores[i])), order.index(i) + 1,
        )
        for i, p in enumerate(candidates)
    ]
    return table.rows.sparkSession.createDataFrame(rows, RANKING_SCHEMA)


def search(
    table: FitTable, schema: dict, candidates: list[BoostingParams], current: BoostingParams = BoostingParams(),
    folds: int = CV_FOLDS, fit=None,
) -> SearchResult:
    """Random search with what follows from it: refitted best model, its folds, and the comparison.

    Fold models are kept, so the folds of the best candidate are not fitted again.
    """
    fit = fit or FitRegistry(scratch_folder(table.rows.sparkSession)).fit
    ranking = random_search(table, schema, candidates, folds, fit)
    best = candidates[ranking.filter("rank = 1").first().candidate]
    model = fit(table, best, "all")
    best_folds = fold_scores(table, schema, best, folds, fit)
    comparison = compare_scores(fold_scores(table, schema, current, folds, fit), best_folds)
    return SearchResult(ranking, best, model, best_folds, comparison)


def write_search(result: SearchResult, folder: str) -> None:
    """Ranking, folds of the best candidate and comparison as tables, and the model, below ``folder``."""
    for name in ("ranking", "best_folds", "comparison"):
        getattr(result, name).coalesce(1).write.mode("overwrite").parquet(f"{folder}/{name}")
    spark = result.ranking.sparkSession
    trees_frame(spark, [result.model]).write.mode("overwrite").parquet(f"{folder}/trees")
    bins_frame(spark, [result.model.bins]).write.mode("overwrite").parquet(f"{folder}/bins")


def compare_scores(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: means, deviations and the mean difference over the shared folds."""
    both = baseline.select("fold", F.col("roc_auc").alias("base")).join(
        candidate.select("fold", F.col("roc_auc").alias("other")), "fold"
    )
    return both.agg(
        F.count("*").alias("folds"),
        F.avg("base").alias("baseline_mean"),
        F.stddev_samp("base").alias("baseline_std"),
        F.avg("other").alias("candidate_mean"),
        F.stddev_samp("other").alias("candidate_std"),
        F.avg(F.col("other") - F.col("base")).alias("mean_difference"),
        F.count_if(F.col("other") > F.col("base")).alias("folds_improved"),
    )


def out_of_fold(
    table: FitTable, schema: dict, spec: CohortSpec, params: BoostingParams,
    folds: int = CV_FOLDS, inner: int = INNER_FOLDS, fit=_new,
) -> DataFrame:
    """Uncalibrated, sigmoid and isotonic probability of every row from models not trained on it.

    Both calibrations of a fold share the same inner tree models. The table is written once.
    """
    table = replace(table, rows=splits.add_folds(table.rows, spec.target, spec.key, inner, "inner", salt=":inner"))
    spark = table.rows.sparkSession
    places = [(k, j) for k in range(folds) for j in (None, *range(inner))]

    def model(place) -> TreeModel:
        k, j = place
        train = table.where(F.col("fold") != k)
        if j is None:
            return fit(train, params, f"fold-{folds}-without-{k}")
        return fit(train.where(F.col("inner") != j), params, f"fold-{folds}-without-{k}-inner-{inner}-without-{j}")

    models = dict(zip(places, boosting.in_parallel(model, places)))

    def curves(place):
        k, j = place
        rows = table.rows.filter((F.col("fold") != k) & (F.col("inner") == j))
        seen = boosting.with_margin(rows, models[place], "__m").select("__m", boosting.LABEL).persist()
        try:
            return tuple(f(seen, "__m", boosting.LABEL) for f in (boosting.fit_sigmoid, boosting.fit_isotonic))
        finally:
            seen.unpersist()

    calibrated = [p for p in places if p[1] is not None]
    fitted = dict(zip(calibrated, boosting.in_parallel(curves, calibrated)))
    whole = None
    for k in range(folds):
        scored, sigmoids, isotonics = table.rows.filter(F.col("fold") == k), [], []
        own = [models[k, j] for j in (None, *range(inner))]
        scored = scored.withColumn("__margins", boosting.margins_of(own, boosting.typed_features(own[0].bins), spark))
        for j in range(inner):
            scored = scored.withColumn(f"__m{j}", F.col("__margins")[j + 1])
            for kind, curve, names in zip("si", fitted[k, j], (sigmoids, isotonics)):
                scored = curve.apply(scored, f"__m{j}", f"__{kind}{j}")
                names.append(F.col(f"__{kind}{j}"))
        part = scored.select(
            col(spec.key).alias("row_id"),
            col(spec.target).alias("y_true"),
            sigmoid(F.col("__margins")[0]).alias("uncalibrated_probability"),
            (sum(sigmoids) / inner).alias("sigmoid_probability"),
            (sum(isotonics) / inner).alias("isotonic_probability"),
        )
        whole = part if whole is None else whole.unionByName(part)
    path = scratch_folder(spark)
    whole.write.parquet(path)
    return spark.read.schema(whole.schema).parquet(path)
