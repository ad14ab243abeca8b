"""Query of operator 13."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.common import documents
from cohortwise.llm.filter_audit import filter_audit


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(documents(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))


QUERIES = {"op13_filter_audit": op13_filter_audit}
ORACLES = {
    "op13_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
m AS (SELECT doc_id, part,
    (CASE WHEN len(words) < 100 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END)
    + (CASE WHEN doc_id > first_id THEN 16 ELSE 0 END) AS mask FROM w),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT part, mask, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM m LEFT JOIN l ON l.doc_id = m.doc_id),
s AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || e.x || f.x AS filter_order FROM s a, s b, s c, s e, s f
  WHERE len(list_distinct([a.x, b.x, c.x, e.x, f.x])) = 5),
p AS (SELECT filter_order, step, 1 << (ascii(substr(filter_order, step, 1)) - 65) AS own,
    coalesce(list_sum(list_transform(range(1, step), lambda i: 1 << (ascii(substr(filter_order, i, 1)) - 65))), 0) AS before
  FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
g AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM d GROUP BY part, mask),
r AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & own = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & own <> 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & CAST(before AS INTEGER) <> 0 AND mask & own <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & own <> 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & CAST(before AS INTEGER) = 0 AND mask & own <> 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM g, p GROUP BY part, filter_order, step, own)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r
""",
}
