"""Query of operator 8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.llm.common import documents
from cohortwise.llm.mixing import repetitions


def op8_water_filling(spark: SparkSession, folder: str) -> DataFrame:
    rows = repetitions(documents(spark, folder).select("doc_id", "text", "source"))
    return rows.select(
        "row.doc_id", "row.source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


QUERIES = {"op8_water_filling": op8_water_filling}
ORACLES = {
    "op8_water_filling": r"""
WITH d AS (SELECT doc_id, source,
    CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) AS draw FROM documents),
t AS (SELECT source, sum(size) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM t),
k AS (SELECT *, [1, 2, 3][(place - 1) % 3 + 1] AS weight, 3 * source_size AS cap FROM r),
l AS (SELECT *, sum(source_size) OVER () AS budget,
    coalesce(sum(cap) OVER (ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent,
    sum(weight) OVER (ORDER BY source_size / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open FROM k),
c AS (SELECT *, cap * open <= (budget - spent) * weight AS clamped FROM l),
g AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE
    CAST((budget - coalesce(sum(CASE WHEN clamped THEN cap END) OVER (), 0)) * weight AS DOUBLE)
      / sum(CASE WHEN NOT clamped THEN weight END) OVER () END AS target FROM c),
s AS (SELECT d.*, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN floor(g.target / g.source_size) ELSE 0 END AS whole,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS so_far
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
x AS (SELECT *, CAST(whole + CASE WHEN 2 * so_far + size <= 2 * (target - whole * source_size) AND source_size > 0 THEN 1 ELSE 0 END AS BIGINT) AS copies FROM s)
SELECT doc_id, source, size, CAST(source_size AS BIGINT) AS source_size, target, copies, copies * size AS taken FROM x
""",
}
