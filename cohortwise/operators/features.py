"""The input schema of a model: ranges, levels and reference values."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.operators.quantiles import exact_quantiles
from cohortwise.operators.unadjusted import levels_of
from cohortwise.spec import CONTINUOUS, AnalysisError, CohortSpec

SCHEMA_FIELDS = (
    "feature string, kind string, minimum double, maximum double, q05 double, q95 double, "
    "reference_value string, levels array<string>"
)


def input_schema(train: DataFrame, features: Iterable[str], spec: CohortSpec) -> dict[str, dict]:
    """Learn the schema from training rows only.

    Continuous features get their range, median and outer quantiles, others their levels and
    most frequent level (the first in text order on ties).
    """
    features = list(features)
    numeric, other = spec.split(features)
    measures = []
    for i, f in enumerate(features):
        if f in numeric:
            value = col(f).cast("double")
            measures += [F.min(value).alias(f"a{i}"), F.max(value).alias(f"b{i}")]
        else:
            measures.append(F.mode(col(f).cast("string"), True).alias(f"b{i}"))
    levels = levels_of(train, other)  # bounds the counts that the modes keep
    row = train.agg(*measures).first()
    quantiles = exact_quantiles(train, numeric, [0.05, 0.5, 0.95]) if numeric else {}
    schema: dict[str, dict] = {}
    for i, f in enumerate(features):
        if row[f"b{i}"] is None:
            raise AnalysisError(f"feature '{f}' has no value in the training rows")
        if f in numeric:
            q05, median, q95 = quantiles[f]
            schema[f] = {
                "kind": CONTINUOUS, "minimum": row[f"a{i}"], "maximum": row[f"b{i}"],
                "q05": q05, "q95": q95, "reference_value": median,
            }
        else:
            schema[f] = {
                "kind": spec.kind(f), "levels": levels[f], "reference_value": row[f"b{i}"],
            }
    return schema


def schema_frame(spark: SparkSession, schema: dict[str, dict]) -> DataFrame:
    """One row per feature."""
    rows = [
        (
            f, s["kind"], s.get("minimum"), s.get("maximum"), s.get("q05"), s.get("q95"),
            str(s["reference_value"]), s.get("levels"),
        )
        for f, s in schema.items()
    ]
    return spark.createDataFrame(rows, SCHEMA_FIELDS)


def schema_from_frame(df: DataFrame) -> dict[str, dict]:
    schema: dict[str, dict] = {}
    for r in df.collect():  # one row per feature
        if r.kind == CONTINUOUS:
            schema[r.feature] = {
                "kind": r.kind, "minimum": r.minimum, "maximum": r.maximum, "q05": r.q05,
                "q95": r.q95, "reference_value": float(r.reference_value),
            }
        else:
            schema[r.feature] = {
                "kind": r.kind, "levels": list(r.levels), "reference_value": r.reference_value,
            }
    return schema
