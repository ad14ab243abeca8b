"""Query of operator 5."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import crc32_of_id, documents
from cohortwise.llm.toxicity import fit, score


def op5_nb_ngram_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    held_out = crc32_of_id() % 5 == 0
    model = fit(docs, labels, ~held_out)
    rows = docs.select("doc_id", "text", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    return score(rows, model, ("doc_id", "held_out"))


QUERIES = {"op5_nb_ngram_toxicity": op5_nb_ngram_toxicity}
ORACLES: dict[str, str] = {}
