"""From raw documents to packed sequences: quality rules, near-duplicates, personal data, mixing, packing.

Every stage takes the table that the stage before wrote, and its decisions take effect on all rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import documents, small_side, written
from cohortwise.llm.mixing import mixed
from cohortwise.llm.packing import pack_documents
from cohortwise.llm.packing_query import settings as pack_settings
from cohortwise.llm.pii import redact
from cohortwise.llm.quality import POLICIES, ledger, verdict
from cohortwise.llm.setsketch import SketchSettings, labelled_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy keeps."""
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), "text")
    return ledger(whole, ("row",)).filter(verdict(POLICIES["v2"])).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest id; rows without an id come last.

    Rows are told apart by a written key, not by their id: of equal ids the row with the smallest hash of its
    columns stays, then the smallest key. Every row that is in no group stays, whatever its id.
    """
    hashed = F.xxhash64(*(docs[c] for c, kind in docs.dtypes if "map<" not in kind))
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), hashed.alias("hash"))
    keyed = written(whole.withColumn("key", F.monotonically_increasing_id()))
    texts = keyed.select("row.doc_id", "row.text", "hash", "key")
    order = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "hash", "key")
    judged = written(
        labelled_documents(texts, SketchSettings(), ("hash", "key")).filter("component is not null").select("component", order.alias("place"))
    )
    groups = judged.groupBy("component").agg(F.count("*").alias("rows"), F.min("place").alias("first")).filter("rows > 1")
    groups = small_side(written(groups.select("component", "first")))
    gone = judged.join(groups, "component").filter("place.key <> first.key").select(F.col("place.key").alias("_gone"))
    gone = small_side(written(gone))
    return keyed.join(gone, keyed["key"] == gone["_gone"], "left_anti").select("row.*")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    clean = redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"])) if "n_chars" in docs.columns else clean


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document occurs as often as it is taken."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return pack_documents(docs, pack_settings())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mixing", mixing),
    ("packing", packing),
]
# Register scores, the trained span classifier and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read by the next."""
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
