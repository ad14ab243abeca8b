"""Query of operator 12."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm.common import documents
from cohortwise.llm.stripes import collocations


def op12_stripes_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations(documents(spark, folder))


QUERIES = {"op12_stripes_collocations": op12_stripes_collocations}
ORACLES = {
    "op12_stripes_collocations": r"""
WITH p AS (SELECT row_number() OVER () AS id, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
w AS (SELECT id, lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM p),
g AS (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(words) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, array_to_string(words[i:i + k - 1], ' ') AS phrase FROM g) GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2 AND f >= 30),
x AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT x.lang, x.phrase, x.k, x.a, x.cut, l.f AS l, r.f AS r,
    CAST((CAST(2000000 AS HUGEINT) * x.a) // (l.f + r.f) AS BIGINT) AS score
  FROM x JOIN f l ON l.lang = x.lang AND l.k = x.cut AND l.phrase = array_to_string(words[1:x.cut], ' ')
  JOIN f r ON r.lang = x.lang AND r.k = x.k - x.cut AND r.phrase = array_to_string(words[x.cut + 1:x.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, array_to_string(words[j:j + m - 1], ' ') AS phrase, max(a) AS most FROM (
    SELECT lang, words, a, m, unnest(range(1, k - m + 2)) AS j FROM c, (SELECT unnest([2, 3]) AS m) WHERE m < k) GROUP BY 1, 2),
d AS (SELECT b.* FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase WHERE i.most IS NULL OR 100 * i.most < 80 * b.a),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM d)
SELECT o.lang, rank, phrase, a, l, r, n.n, score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
""",
}
