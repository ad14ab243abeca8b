"""Query of operator 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import crc32_of_id, documents
from cohortwise.llm.language import fit, predict


def op4_centroid_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = crc32_of_id() % 4 == 2
    model = fit(docs, ~held_out)
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return predict(rows, model, ("doc_id", "held_out"))


QUERIES = {"op4_centroid_language": op4_centroid_language}
ORACLES: dict[str, str] = {}
