"""Evaluation of probabilities and classes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, rate
from cohortwise.operators.ordering import running_totals
from cohortwise.spec import AnalysisError

DEFAULT_THRESHOLD = 0.5
MACHINE_EPSILON = 2.220446049250313e-16  # fixed value: probabilities are clipped to it
THRESHOLDS = tuple(round(0.05 + i / 100, 2) for i in range(91))
SCAN_METRICS = (
    "accuracy", "precision", "recall", "specificity", "balanced_accuracy", "f1",
)
STORED_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _outcomes(df: DataFrame, y: str, p: str, classes: Iterable[str] = ()) -> DataFrame:
    """How many rows share an outcome, a probability and the named classes: all that one evaluation reads, in one pass."""
    named = [col(c).alias(f"__{c}") for c in classes]
    return df.groupBy(col(y).alias("__y"), col(p).cast("double").alias("__p"), *named).agg(F.count("*").alias("__n")).persist()


def _times(condition: Column) -> Column:
    """Rows behind the counted ones for which the condition holds."""
    return F.coalesce(F.sum(F.when(condition, F.col("__n"))), F.lit(0))


def roc_auc(df: DataFrame, y: str, p: str, groups: Iterable[str] = (), n: str | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; one row per group.

    Rows are first reduced to distinct scores, so any number of equal scores is one row. ``n`` counts the rows behind one.
    """
    groups = list(groups)

    def rows(condition: Column) -> Column:
        return F.count_if(condition) if n is None else F.sum(F.when(condition, col(n)).otherwise(0))

    scores = df.groupBy(*groups, col(p).cast("double").alias("__p")).agg(
        rows(col(y) == 1).alias("__pos"), rows(col(y) == 0).alias("__neg")
    ).persist()
    return _area(scores, groups)


def _counted_auc(counted: DataFrame) -> DataFrame:
    """The area from counted outcomes."""
    return _area(counted.groupBy("__p").agg(_times(F.col("__y") == 1).alias("__pos"), _times(F.col("__y") == 0).alias("__neg")).persist(), [])


def _area(scores: DataFrame, groups: list[str]) -> DataFrame:
    ranked = running_totals(scores, "__p", {"__below": "__neg"}, groups)
    wins = F.sum(F.col("__pos") * (F.col("__below") + F.col("__neg") / 2))
    pairs = F.sum("__pos").cast("double") * F.sum("__neg").cast("double")
    return ranked.groupBy(*groups).agg(rate(wins, pairs).alias("roc_auc"))


def probability_columns(y: Column, p: Column, n: Column | None = None) -> dict[str, Column]:
    """Aggregates that judge probabilities: Brier score, log loss, rates and bias; ``n`` counts the rows behind one."""
    y, p = y.cast("double"), p.cast("double")

    def mean(value: Column) -> Column:
        return F.avg(value) if n is None else F.sum(value * n) / F.sum(F.when(value.isNotNull(), n))

    safe = F.least(F.greatest(p, F.lit(MACHINE_EPSILON)), F.lit(1 - MACHINE_EPSILON))
    loss = -(y * F.log(safe) + (1 - y) * F.log(1 - safe))
    return {
        "brier_score": mean((p - y) * (p - y)),
        "log_loss": mean(loss),
        "actual_positive_rate": mean(y),
        "mean_predicted_probability": mean(p),
        "mean_probability_bias": mean(p) - mean(y),
    }


def class_columns(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Class metrics from the four counts; a zero denominator gives 0, specificity null."""
    recall = rate(tp, tp + fn, 0.0)
    specificity = rate(tn, tn + fp)
    return {
        "accuracy": rate(tp + tn, tp + fp + fn + tn),
        "precision": rate(tp, tp + fp, 0.0),
        "recall": recall,
        "specificity": specificity,
        "balanced_accuracy": (recall + specificity) / 2,
        "f1": rate(2 * tp, 2 * tp + fp + fn, 0.0),
    }


def confusion_counts(y: Column, yhat: Column, count=F.count_if) -> dict[str, Column]:
    return {
        "tp": count((y == 1) & (yhat == 1)),
        "fp": count((y == 0) & (yhat == 1)),
        "fn": count((y == 1) & (yhat == 0)),
        "tn": count((y == 0) & (yhat == 0)),
    }


def evaluate(df: DataFrame, y: str, p: str, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One row with every evaluation metric of a scored table."""
    counted = _outcomes(df, y, p)
    actual, probability = F.col("__y"), F.col("__p")
    yhat = (probability >= threshold).cast("int")
    row = counted.agg(
        _times(F.lit(True)).alias("test_rows"),
        *[c.alias(n) for n, c in confusion_counts(actual, yhat, _times).items()],
        *[c.alias(n) for n, c in probability_columns(actual, probability, F.col("__n")).items()],
    )
    classes = class_columns(*[F.col(n) for n in ("tp", "fp", "fn", "tn")])
    auc = _counted_auc(counted)
    return row.join(F.broadcast(auc)).select(  # one row each
        "test_rows",
        *[classes[n].alias(n) for n in ("accuracy", "precision", "recall", "f1")],
        "roc_auc",
        "brier_score",
        "log_loss",
        "actual_positive_rate",
        "mean_predicted_probability",
        "mean_probability_bias",
    )


def stack_probabilities(df: DataFrame, y: str, probabilities: dict[str, str]) -> DataFrame:
    """One row per record and named probability column: ``model, y, p``."""
    entries = [
        F.struct(F.lit(m).alias("model"), col(y).alias("y"), col(p).cast("double").alias("p"))
        for m, p in probabilities.items()
    ]
    return df.select(F.inline(F.array(*entries)))


def probability_metrics(df: DataFrame, y: str, probabilities: dict[str, str]) -> DataFrame:
    """Probability metrics per named column, best Brier score first."""
    stacked = stack_probabilities(df, y, probabilities)
    bad = F.count_if(F.col("p").isNull() | F.isnan("p") | (F.col("p") < 0) | (F.col("p") > 1))
    table = stacked.groupBy("model").agg(
        *[c.alias(n) for n, c in probability_columns(F.col("y"), F.col("p")).items()],
        F.when(bad > 0, F.raise_error(F.lit("probabilities must be in [0, 1]"))).alias("__check"),
    )
    auc = roc_auc(stacked, "y", "p", ["model"])
    table = table.join(auc, "model")
    return table.select(
        "model",
        F.coalesce(F.col("__check").cast("double"), "roc_auc").alias("roc_auc"),
        *probability_columns(F.col("y"), F.col("p")),
    ).orderBy("brier_score")


def change_against(metrics: DataFrame, baseline: str) -> DataFrame:
    """Metric changes of every variant against the baseline variant."""
    names = ("brier_score", "log_loss", "roc_auc")
    base = metrics.filter(F.col("model") == baseline).select(
        *[F.col(n).alias(f"base_{n}") for n in names]
    )
    return (
        metrics.filter(F.col("model") != baseline)
        .join(F.broadcast(base))  # a single row
        .select("model", *[(F.col(n) - F.col(f"base_{n}")).alias(f"{n}_change") for n in names])
    )


def threshold_scan(df: DataFrame, y: str, p: str, thresholds=THRESHOLDS) -> DataFrame:
    """Class metrics at every threshold from one pass over the rows.

    Each row only falls into the interval between two thresholds (``>=`` decides); the counts
    of at most ``len(thresholds) + 1`` intervals are then accumulated from the top.
    """
    spark, size = df.sparkSession, len(thresholds)
    cutter = Bucketizer(
        splits=[-float("inf"), *thresholds, float("inf")], inputCol="p", outputCol="slot"
    )
    rows = df.select(col(y).cast("int").alias("y"), col(p).cast("double").alias("p"))
    counted = cutter.transform(rows).groupBy(F.col("slot").cast("int").alias("slot")).agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )
    slots = spark.range(size + 1).select(F.col("id").cast("int").alias("slot"))
    full = slots.join(F.broadcast(counted), "slot", "left").na.fill(0, ["pos", "neg"])
    one = Window.partitionBy(F.lit(0))  # size + 1 rows
    upwards = one.orderBy(F.desc("slot"))
    tp, fp = F.sum("pos").over(upwards), F.sum("neg").over(upwards)
    counts = full.select(
        "slot",
        tp.alias("tp"),
        fp.alias("fp"),
        (F.sum("pos").over(one) - tp).alias("fn"),
        (F.sum("neg").over(one) - fp).alias("tn"),
    ).filter("slot > 0")
    values = F.array(*[F.lit(float(t)) for t in thresholds])
    classes = class_columns(*[F.col(n) for n in ("tp", "fp", "fn", "tn")])
    everything = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return counts.select(
        F.element_at(values, F.col("slot")).alias("threshold"),
        *[classes[n].alias(n) for n in SCAN_METRICS],
        "tn",
        "fp",
        "fn",
        "tp",
        rate(F.col("tp") + F.col("fp"), everything).alias("predicted_positive_rate"),
    )


def select_thresholds(scan: DataFrame, default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """The default threshold, the best by two metrics, and the one balancing precision/recall."""
    row = F.struct(*scan.columns)
    t = F.col("threshold")
    gap = F.abs(F.col("precision") - F.col("recall"))
    picked = scan.agg(
        F.min_by(row, F.struct(F.abs(t - default), t)).alias("default"),
        F.min_by(row, F.struct(-F.col("f1"), t)).alias("best_f1"),
        F.min_by(row, F.struct(-F.col("balanced_accuracy"), t)).alias("best_balanced_accuracy"),
        F.min_by(row, F.struct(gap, t)).alias("closest_precision_recall"),
    )
    return picked.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(n).alias("selection"), *[F.col(n)[c].alias(c) for c in scan.columns])
                    for n in picked.columns
                ]
            )
        )
    )


def threshold_deltas(selected: DataFrame) -> DataFrame:
    """Changes of each selected threshold against the default one."""
    names = ("threshold", "accuracy", "precision", "recall", "f1")
    one = Window.partitionBy(F.lit(0))  # four rows

    def base(name: str) -> Column:
        return F.max(F.when(F.col("selection") == "default", F.col(name))).over(one)

    return selected.select(
        "selection", *[(F.col(n) - base(n)).alias(f"{n}_change") for n in names]
    ).filter(F.col("selection") != "default")


def roc_points(df: DataFrame, y: str, p: str) -> DataFrame:
    """False and true positive rate at every distinct score, from the origin upwards."""
    scores = df.groupBy(col(p).cast("double").alias("threshold")).agg(
        F.count_if(col(y) == 1).alias("pos"), F.count_if(col(y) == 0).alias("neg")
    ).persist()
    total = scores.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).first()
    if not total.pos or not total.neg:
        raise AnalysisError("a ROC curve needs both outcomes")
    below = running_totals(scores, "threshold", {"pos_below": "pos", "neg_below": "neg"})
    points = below.select(
        "threshold",
        ((F.lit(total.neg) - F.col("neg_below")) / F.lit(float(total.neg))).alias("fpr"),
        ((F.lit(total.pos) - F.col("pos_below")) / F.lit(float(total.pos))).alias("tpr"),
    )
    origin = df.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return origin.unionByName(points)


def confusion_matrix(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """All four actual by predicted counts."""
    row = df.agg(*[c.alias(n) for n, c in confusion_counts(col(y), col(yhat)).items()])
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return row.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(n).alias("n"))
                    for a, b, n in cells
                ]
            )
        )
    )


def artefact_consistency(metrics: DataFrame, predictions: DataFrame) -> DataFrame:
    """Stored metrics next to the same metrics recomputed from stored predictions."""
    counted = _outcomes(predictions, "y_test", "y_proba", ["y_pred"])
    counts = counted.agg(
        _times(F.lit(True)).alias("rows"),
        *[c.alias(n) for n, c in confusion_counts(F.col("__y"), F.col("__y_pred"), _times).items()],
    )
    classes = class_columns(*[F.col(n) for n in ("tp", "fp", "fn", "tn")])
    auc = _counted_auc(counted)
    again = counts.join(F.broadcast(auc)).select(
        F.col("rows").cast("double").alias("test_rows"),
        *[classes[n].alias(n) for n in STORED_METRICS if n != "roc_auc"],
        "roc_auc",
    )
    names = ["test_rows", *STORED_METRICS]
    stored = metrics.select(*[F.col(n).cast("double").alias(f"stored_{n}") for n in names])
    both = stored.join(F.broadcast(again)).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(n).alias("metric"),
                        F.col(f"stored_{n}").alias("stored"),
                        F.col(n).alias("recomputed"),
                    )
                    for n in names
                ]
            )
        )
    )
    limit = 1e-12 + 1e-9 * F.abs("recomputed")
    return both.withColumn("consistent", F.abs(F.col("stored") - F.col("recomputed")) <= limit)


def require_consistency(metrics: DataFrame, predictions: DataFrame) -> None:
    bad = artefact_consistency(metrics, predictions).filter(~F.col("consistent")).collect()
    if bad:
        raise AnalysisError(
            "stored metrics do not belong to the stored predictions: "
            + ", ".join(f"{r.metric} {r.stored} != {r.recomputed}" for r in bad)
        )
