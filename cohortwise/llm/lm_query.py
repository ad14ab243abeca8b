"""Query of operator 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.backoff_lm import language_model_scores
from cohortwise.llm.common import documents


def op10_backoff_lm(spark: SparkSession, folder: str) -> DataFrame:
    return language_model_scores(documents(spark, folder))


QUERIES = {"op10_backoff_lm": op10_backoff_lm}
# The checksum of an id is folded bit by bit; a space stands for the end, an empty word for the begin.
ORACLES = {
    "op10_backoff_lm": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(xor(list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
      lambda a, c: list_reduce(list_concat([xor(a, c)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 7 = 2, false) AS held_out,
    list_concat(list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x20\x09-\x0D]+'), lambda x: x <> ''), [' ']) AS words FROM documents),
t AS (SELECT r, held_out, words[i] AS w, CASE WHEN i = 1 THEN '' ELSE words[i - 1] END AS v
  FROM (SELECT r, held_out, words, unnest(range(1, len(words) + 1)) AS i FROM d)),
u AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
z AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS k FROM u),
h AS (SELECT w AS v, c FROM u UNION ALL SELECT '', count(*) FROM d WHERE NOT held_out),
b AS (SELECT v, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY v, w),
e AS (SELECT length(bin(h.c)) AS bits, (count(*) FILTER (WHERE b.c = 1) + 1) / (sum(b.c) + 2)::DOUBLE AS leave
  FROM b JOIN h USING (v) GROUP BY 1),
p AS (SELECT t.r, u.c IS NOT NULL AS known, (coalesce(u.c, 0) + 1) / (z.n + z.k + 1)::DOUBLE AS low,
    CASE WHEN coalesce(h.c, 0) = 0 THEN 1.0::DOUBLE ELSE e.leave END AS leave,
    CASE WHEN coalesce(h.c, 0) = 0 THEN 0.0::DOUBLE ELSE coalesce(b.c, 0) / h.c::DOUBLE END AS own
  FROM t CROSS JOIN z LEFT JOIN u ON u.w = t.w LEFT JOIN h ON h.v = t.v
  LEFT JOIN b ON b.v = t.v AND b.w = t.w LEFT JOIN e ON e.bits = length(bin(h.c))),
s AS (SELECT r, count(*) AS n_tokens, count(*) FILTER (WHERE known) AS n_known, sum(log10(low)) AS base_score,
    sum(log10((1 - leave) * own + leave * low)) AS score FROM p GROUP BY r)
SELECT d.doc_id, d.held_out, s.n_tokens, s.n_known, z.n AS train_tokens, s.base_score, s.score
FROM d JOIN s USING (r) CROSS JOIN z
""",
}
