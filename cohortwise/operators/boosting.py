"""Boosted trees with sigmoid or isotonic calibration.

Missing numbers take the training median, missing and unseen levels a code of their own; classes have
balanced weights. See ``trees`` for how a fit is spread over tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col, hash_uniform, sigmoid
from cohortwise.operators.isotonic import IsotonicCurve, isotonic_curve
from cohortwise.operators.trees import TREE_SCHEMA, FeatureBins, Patterns, TreeModel, boosted_patterns, feature_bins, summed_through
from cohortwise.session import scratch_folder
from cohortwise.spec import CONTINUOUS, AnalysisError

CALIBRATION_FOLDS = 3
SEED = 42
PARALLEL_FITS = 8
TASK_ROWS = 4_000_000  # beyond so many rows tasks share a fit
FILE_ROWS = 250_000
LABEL, WEIGHT = "__label", "__weight"
PROBABILITY = "probability"


@dataclass(frozen=True)
class BoostingParams:
    """Fixed values of the default model. ``fit_rows`` only says how large a sample is for those who ask for one
    (``fit_table``); training, evaluation and experiments fit on all labelled rows (``whole_table``).
    """

    learning_rate: float = 0.14447746112718687
    max_iter: int = 154
    max_depth: int | None = 5
    max_leaf_nodes: int | None = 31
    min_rows_per_leaf: int = 20
    l2: float = 0.45606998421703593
    max_bins: int = 255
    fit_rows: int = 4_000_000

    def with_(self, **changes) -> BoostingParams:
        return replace(self, **changes)


@dataclass(frozen=True)
class FitTable:
    """Labelled rows in the shared folder that fits read, with their bins.

    ``tasks`` follows from the number of rows, so a small table is one task whatever the cores; there are no more
    than cores, since tasks that share a fit run at the same time.
    """

    rows: DataFrame
    bins: FeatureBins
    tasks: int
    fingerprint: str
    key: str = ""  # orders the rows of tasks that share a fit

    def where(self, condition: Column) -> FitTable:
        return replace(self, rows=self.rows.filter(condition))


def add_training_columns(df: DataFrame, target: str) -> DataFrame:
    """Add the label and balanced class weights n / (2 * n_class)."""
    sizes = {r.y: r["count"] for r in df.groupBy(col(target).cast("int").alias("y")).count().collect()}
    if set(sizes) != {0, 1}:
        raise AnalysisError("training needs both classes")
    total = sizes[0] + sizes[1]
    y = col(target).cast("int")
    weight = F.when(y == 1, total / (2.0 * sizes[1])).otherwise(total / (2.0 * sizes[0]))
    return df.withColumn(LABEL, y.cast("double")).withColumn(WEIGHT, weight)


def feature_columns(schema: dict[str, dict]) -> list[Column]:
    """The features as the bins take them: numbers as doubles, levels as text."""
    return [
        col(f).cast("double" if s["kind"] == CONTINUOUS else "string").alias(f) for f, s in schema.items()
    ]


def fit_table(
    df: DataFrame, schema: dict[str, dict], target: str, key: str, keep: tuple[str, ...] = (),
    params: BoostingParams = BoostingParams(),
) -> FitTable:
    """As ``whole_table``, but of more than ``params.fit_rows`` rows about as many, by hash of their keys."""
    rows, n = add_training_columns(df, target), df.count()
    if n > params.fit_rows:
        rows, n = rows.filter(hash_uniform(col(key).cast("string"), "fit") < params.fit_rows / n), params.fit_rows
    return _written(rows, n, schema, target, key, keep, params)


def whole_table(
    df: DataFrame, schema: dict[str, dict], target: str, key: str, keep: tuple[str, ...] = (),
    params: BoostingParams = BoostingParams(),
) -> FitTable:
    """Write what fits need of all rows: key, target, features, label, weight and the columns of ``keep``."""
    return _written(add_training_columns(df, target), df.count(), schema, target, key, keep, params)


def _written(rows: DataFrame, n: int, schema, target: str, key: str, keep, params: BoostingParams) -> FitTable:
    spark = rows.sparkSession
    kept = [c for c in dict.fromkeys((key, target, *keep)) if c not in schema]
    rows = rows.select(*[col(c) for c in kept], *feature_columns(schema), LABEL, WEIGHT)
    parts, path = -(-n // FILE_ROWS), scratch_folder(spark)
    # an order of their own makes the bins the same in every run
    rows.repartition(parts, col(key)).sortWithinPartitions(col(key)).write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    total = rows.agg(F.count("*"), F.sum(F.pmod(F.xxhash64(*[col(c) for c in rows.columns]), F.lit(1 << 40)))).first()
    tasks = min(-(-n // TASK_ROWS), spark.sparkContext.defaultParallelism)
    return FitTable(rows, feature_bins(rows, schema, params.max_bins), tasks, f"{total[0]}-{total[1]}", key)


def fit_tree(table: FitTable, params: BoostingParams) -> TreeModel:
    """One additive model of all rows of the table."""
    bins, tasks, dealt = table.bins, table.tasks, table.rows.select(*[col(f) for f in table.bins.names], LABEL, WEIGHT)
    exchange = scratch_folder(table.rows.sparkSession).removeprefix("file://").removeprefix("file:")

    def encoded(batches):
        for batch in batches:
            codes = bins.codes(batch.columns[:-2])
            packed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(4 * codes.shape[1]), len(codes), [None, pa.py_buffer(codes.tobytes())]
            ).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([packed, batch.column(LABEL), batch.column(WEIGHT)], names=["codes", LABEL, WEIGHT])

    def grow(batches):
        rows, n = Patterns(bins), 0
        for batch in batches:
            if tasks == 1:
                codes = bins.codes(batch.columns[:-2])
            else:
                codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.int32).reshape(len(batch), -1)
            rows.add(codes, batch.column(LABEL).to_numpy(), batch.column(WEIGHT).to_numpy())
            n += len(batch)
        if tasks == 1 and not n:
            return
        if tasks == 1:
            grown, first = boosted_patterns(rows, bins, params), True
        else:
            from pyspark import BarrierTaskContext

            grown = boosted_patterns(rows, bins, params, summed_through(exchange), True)
            first = BarrierTaskContext.get().partitionId() == 0  # all tasks have grown the same trees
        columns = list(zip(*TreeModel(bins, grown).rows())) if first else [[]] * 6
        kinds = (pa.int32(), *[pa.list_(pa.int32())] * 3, pa.list_(pa.float64()), pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([[bytes(x) for x in v] for v in c] if k == kinds[-1] else list(c), k) for c, k in zip(columns, kinds)],
            names=["tree", "features", "left", "right", "values", "goes_left"],
        )

    if tasks == 1:
        dealt = dealt.coalesce(1)
    else:
        # a barrier stage begins with a shuffle, and equal codes meet in one task
        dealt = dealt.mapInArrow(encoded, f"codes binary, {LABEL} double, {WEIGHT} double").repartition(tasks, "codes")
    grown = dealt.mapInArrow(grow, TREE_SCHEMA, barrier=tasks > 1).collect()
    if not grown:
        raise AnalysisError("there are no rows to fit")
    return TreeModel.from_rows(bins, grown)


def margins_of(models: list[TreeModel], schema_kinds: list[Column], spark) -> Column:
    """The log-odds of several models over the same features, as an array column."""
    sent = spark.sparkContext.broadcast(models)

    @F.arrow_udf("array<double>")
    def margins(record: pa.Array) -> pa.Array:
        columns, bins, found = record.flatten(), None, []
        for m in sent.value:
            if m.bins != bins:  # models of one table share their bins
                bins, codes = m.bins, m.bins.codes(columns)
            found.append(m.margins_at(codes))
        found = np.stack(found, axis=1) if len(record) else np.zeros((0, 1))
        ends = np.arange(len(record) + 1, dtype=np.int32) * len(sent.value)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(found.ravel()))

    return margins(F.struct(*schema_kinds))


def typed_features(bins: FeatureBins) -> list[Column]:
    return [col(f).cast("double" if f in bins.edges else "string").alias(f"f{i}") for i, f in enumerate(bins.names)]


def with_margin(df: DataFrame, model: TreeModel, out: str) -> DataFrame:
    """Add the additive score of the trees as log-odds."""
    return df.withColumn(out, margins_of([model], typed_features(model.bins), df.sparkSession)[0])


@dataclass
class SigmoidCalibration:
    slope: float
    intercept: float

    def apply(self, df: DataFrame, margin: str, out: str) -> DataFrame:
        return df.withColumn(out, sigmoid(self.slope * F.col(margin) + self.intercept))


@dataclass
class IsotonicCalibration:
    curve: IsotonicCurve

    def apply(self, df: DataFrame, margin: str, out: str) -> DataFrame:
        return df.withColumn(out, self.curve.values_at(F.col(margin), df.sparkSession))


def fit_sigmoid(scored: DataFrame, margin: str, label: str) -> SigmoidCalibration:
    """Logistic curve through smoothed targets, fitted on rows the trees have not seen."""
    y = F.col(label)
    row = scored.agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg")).first()
    target = F.when(y == 1, (row.pos + 1.0) / (row.pos + 2.0)).otherwise(1.0 / (row.neg + 2.0))
    one = VectorAssembler(inputCols=[margin], outputCol="__margin_vector")
    rows = one.transform(scored.withColumn("__smoothed", target))
    model = GeneralizedLinearRegression(
        family="binomial", featuresCol="__margin_vector", labelCol="__smoothed", maxIter=100, tol=1e-10
    ).fit(rows)
    return SigmoidCalibration(float(model.coefficients[0]), float(model.intercept))


def fit_isotonic(scored: DataFrame, margin: str, label: str) -> IsotonicCalibration:
    return IsotonicCalibration(isotonic_curve(scored, margin, label))


@dataclass
class CalibratedModel:
    """Several tree models, each with its own calibration; probabilities are averaged."""

    schema: dict[str, dict]
    trees: list[TreeModel]
    calibrations: list

    def score(self, df: DataFrame, out: str = PROBABILITY) -> DataFrame:
        """Add the probability, row by row; also works on a streaming DataFrame."""
        ready = df.withColumn("__margins", margins_of(self.trees, typed_features(self.trees[0].bins), df.sparkSession))
        parts = []
        for i, calibration in enumerate(self.calibrations):
            ready = ready.withColumn(f"__margin{i}", F.col("__margins")[i])
            ready = calibration.apply(ready, f"__margin{i}", f"__p{i}")
            parts.append(f"__p{i}")
        mean = sum(F.col(p) for p in parts) / len(parts)
        return ready.withColumn(out, mean).drop("__margins", *parts, *[f"__margin{i}" for i in range(len(parts))])


def in_parallel(work, items: list) -> list:
    """Fits are independent jobs; as many at a time as the scheduler can use."""
    if not items:
        return []
    with ThreadPool(min(len(items), PARALLEL_FITS)) as pool:
        return pool.map(work, items, chunksize=1)


def fit_calibrated(
    table: FitTable, schema: dict[str, dict], params: BoostingParams, fold: str,
    folds: int = CALIBRATION_FOLDS, fit=None,
) -> CalibratedModel:
    """One tree model per fold, trained on the other folds and calibrated on the fold itself.

    ``fit`` takes a table, parameters and a name; the default fits, a registry looks the name up first.
    """
    fit = fit or (lambda part, p, name: fit_tree(part, p))

    def one(k: int):
        trees = fit(table.where(F.col(fold) != k), params, f"{fold}-{folds}-without-{k}")
        held = with_margin(table.rows.filter(F.col(fold) == k), trees, "__margin").select("__margin", LABEL)
        held = held.persist()
        try:
            return trees, fit_sigmoid(held, "__margin", LABEL)
        finally:
            held.unpersist()

    fitted = in_parallel(one, list(range(folds)))
    return CalibratedModel(schema, [t for t, _ in fitted], [c for _, c in fitted])


def classify(df: DataFrame, threshold: float, probability: str = PROBABILITY) -> DataFrame:
    """Add the class: 1 from the threshold on."""
    return df.withColumn("predicted_class", (col(probability) >= threshold).cast("int"))
