"""Query of operator 2."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import documents, written
from cohortwise.llm.quality import BASE_MASK, POLICIES, ablations, ledger, verdict


def stored_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of ``documents``, written once; what follows from it reads bits only, no text."""
    return written(ledger(documents(spark, folder)))


def op2_rule_ledger(spark: SparkSession, folder: str) -> DataFrame:
    rows = stored_ledger(spark, folder)
    failed = F.col("fail_bits").bitwiseAND(F.lit(BASE_MASK).cast("long")) != 0
    return rows.withColumn("base_failed", failed).withColumn("kept", verdict(POLICIES["v2"]))


def op2_rule_policies(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``fail_bits`` and the verdict of every policy version."""
    verdicts = [verdict(policy).alias(f"kept_{version}") for version, policy in POLICIES.items()]
    return stored_ledger(spark, folder).select("doc_id", "fail_bits", *verdicts)


def op2_rule_ablations(spark: SparkSession, folder: str) -> DataFrame:
    """``version`` and the ablation of each rule, for every policy version over the whole table."""
    rows = stored_ledger(spark, folder)
    found = None
    for version, policy in POLICIES.items():
        part = ablations(rows, policy).select(F.lit(version).alias("version"), "*")
        found = part if found is None else found.unionByName(part)
    return found


QUERIES = {
    "op2_rule_ledger": op2_rule_ledger,
    "op2_rule_policies": op2_rule_policies,
    "op2_rule_ablations": op2_rule_ablations,
}
ORACLES = {
    "op2_rule_ledger": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text,
    list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM t),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, i + unnest([0, 1, 2]) AS p FROM r) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper,
    CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS n_letters
  FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
b AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END)
    + (CASE WHEN 2 * word_chars < 5 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 32 ELSE 0 END)
    + (CASE WHEN 100 * n_upper > 50 * n_letters THEN 64 ELSE 0 END) AS BIGINT) AS fail_bits FROM m)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, fail_bits = 0 AS kept FROM b
""",
}
