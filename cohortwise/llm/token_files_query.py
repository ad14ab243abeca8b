"""Query of operator 1."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import documents
from cohortwise.llm.token_files import TokenFileSettings, read_token_files, write_token_files
from cohortwise.session import scratch_folder


def op1_rans_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_folder(spark)
    settings = TokenFileSettings(public_tokenizers.path("word_bpe_49k.json"))
    write_token_files(documents(spark, folder), files, settings)
    return read_token_files(spark, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {"op1_rans_token_files": op1_rans_token_files}
ORACLES: dict[str, str] = {}
