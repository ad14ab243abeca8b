"""Query of operator 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.common import documents
from cohortwise.llm.pii import find_personal_data


def op9_weak_supervision_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(documents(spark, folder))


QUERIES = {"op9_weak_supervision_pii": op9_weak_supervision_pii}
ORACLES: dict[str, str] = {}
