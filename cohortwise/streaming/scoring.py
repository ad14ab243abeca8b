"""Scoring on a stream: the batch operators are row-wise, so they apply unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cohortwise.operators.boosting import CalibratedModel, classify
from cohortwise.operators.metrics import DEFAULT_THRESHOLD


def score_stream(
    records: DataFrame, model: CalibratedModel, threshold: float = DEFAULT_THRESHOLD
) -> DataFrame:
    """Add probability and class to a streaming (or batch) DataFrame of records."""
    return classify(model.score(records), threshold)
