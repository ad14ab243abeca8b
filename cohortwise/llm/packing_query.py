"""Query of operator 6."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.common import documents
from cohortwise.llm.packing import PackSettings, pack_documents


def settings() -> PackSettings:
    return PackSettings(public_tokenizers.path("byte_bpe_50k.json"))


def op6_ffd_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(documents(spark, folder), settings())


QUERIES = {"op6_ffd_packing": op6_ffd_packing}
ORACLES: dict[str, str] = {}
