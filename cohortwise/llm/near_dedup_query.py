"""Query of operator 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.common import documents
from cohortwise.llm.setsketch import near_duplicates


def op7_setsketch_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(documents(spark, folder))


QUERIES = {"op7_setsketch_dedup": op7_setsketch_dedup}
# All pairs by a join on shared shingles, for small tables; the recursion walks the confirmed links.
ORACLES = {
    "op7_setsketch_dedup": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[]
    WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i+1] || ' ' || words[i+2]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS k FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b WHERE 100 * shared >= 85 * (x.k + y.k - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS reached FROM documents
  UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.reached),
c AS (SELECT node, min(reached) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id
""",
}
