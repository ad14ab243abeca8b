"""SQL text of the cohort views, for checking results with an independent engine."""

from __future__ import annotations


def uniform(salt: str, key: str = "row_id") -> str:
    return f"(CAST('0x' || substr(md5({key} || ':{salt}'), 1, 8) AS BIGINT) / 4294967296.0)"


COHORT = f"""
base AS (
  SELECT md5(l_orderkey || '|' || l_linenumber || '|' || l_partkey || '|' || l_suppkey || '|' ||
             CAST(round(l_extendedprice * 100) AS BIGINT)) AS row_id,
         l_quantity AS quantity, l_discount AS discount, l_linestatus AS line_status,
         l_returnflag AS return_flag, CAST(l_extendedprice > 60000 AS INTEGER) AS high_value,
         o_orderpriority AS priority, c_mktsegment AS segment, c_acctbal AS balance,
         n_name AS nation,
         -2.0::DOUBLE + 0.06::DOUBLE * l_quantity
           + 0.8::DOUBLE * CAST(l_returnflag = 'R' AS INTEGER)
           - 0.5::DOUBLE * CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS linear
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
cohort AS (
  SELECT *, CAST(score >= 0.5 AS INTEGER) AS predicted FROM (
    SELECT *,
      CAST({uniform('y')} < 1 / (1 + exp(-linear)) AS INTEGER) AS outcome,
      CASE WHEN {uniform('x')} < 1 / (1 + exp(-(0.05::DOUBLE * (quantity - 25))))
           THEN 'yes' ELSE 'no' END AS exposed,
      round(1 / (1 + exp(-(linear + 2.0::DOUBLE * ({uniform('s')} - 0.5)))), 3) AS score
    FROM base)
)"""

RAW = """
raw_once AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_key,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL WHEN l_partkey % 31 = 0 THEN '12 units'
         WHEN l_suppkey % 29 = 0 THEN CAST(CAST(l_quantity AS INTEGER) * 10 AS VARCHAR)
         ELSE ' ' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS quantity,
    CAST(l_discount AS VARCHAR) AS discount,
    CASE WHEN l_partkey % 19 = 0 THEN ' ? ' ELSE '  ' || c_mktsegment || ' ' END AS segment,
    CASE WHEN l_orderkey % 13 = 0 THEN '' ELSE l_returnflag END AS return_flag,
    CASE WHEN l_partkey % 97 = 0 THEN 'unknown' WHEN l_partkey % 89 = 0 THEN NULL
         ELSE (CASE WHEN l_extendedprice > 60000 THEN '>60K' ELSE '<=60K' END) ||
              (CASE WHEN l_suppkey % 3 = 0 THEN '.' ELSE '' END) END AS price_class
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
),
raw AS (
  SELECT * FROM raw_once
  UNION ALL SELECT * FROM raw_once WHERE CAST(order_key AS BIGINT) % 23 = 0
)"""


def _tidy(name: str) -> str:
    tokens = "'?', ''"
    return f"CASE WHEN trim({name}) IN ({tokens}) THEN NULL ELSE trim({name}) END"


NORMALISED = RAW + f""",
normalised AS (
  SELECT {_tidy('order_key')} AS order_key, {_tidy('quantity')} AS quantity,
         {_tidy('discount')} AS discount, {_tidy('segment')} AS segment,
         {_tidy('return_flag')} AS return_flag,
         rtrim({_tidy('price_class')}, '.') AS price_class
  FROM raw
)"""

COERCED = NORMALISED + """,
coerced AS (
  SELECT order_key, TRY_CAST(quantity AS DOUBLE) AS quantity, TRY_CAST(discount AS DOUBLE) AS discount,
         segment, return_flag, price_class
  FROM normalised
)"""

VALID = (
    "(quantity IS NULL OR quantity BETWEEN 1 AND 50) AND (discount IS NULL OR discount >= 0) "
    "AND (price_class IS NULL OR price_class IN ('<=60K', '>60K'))"
)
TARGET = "CASE price_class WHEN '<=60K' THEN 0 WHEN '>60K' THEN 1 END"

PROFILED = COERCED + f""",
profiled AS (SELECT *, {TARGET} AS high_value FROM coerced)"""

REVIEW = """
review AS (
  SELECT labels.doc_id, quality, CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS toxic,
         CAST(n_chars AS DOUBLE) AS n_chars, lang, source
  FROM labels JOIN documents ON labels.doc_id = documents.doc_id
)"""


def with_(*parts: str) -> str:
    return "WITH RECURSIVE " + ",".join(p.strip() for p in parts) + "\n"


def t_two_sided(t: str, dof: str) -> str:
    """P(|T| > |t|) by Simpson's rule over the density between 0 and |t|."""
    return f"""(1 - 2 * exp(lgamma(({dof} + 1) / 2.0) - lgamma({dof} / 2.0)) / sqrt({dof} * pi())
      * abs({t}) / 4000 / 3 * list_sum(list_transform(range(0, 4001), lambda i:
        (CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
        * exp(-({dof} + 1) / 2.0 * ln(1 + pow({t} * i / 4000.0, 2) / {dof})))))"""


def chi2_sf(x: str, dof: str) -> str:
    """P(chi-square > x) by Simpson's rule over the density of the square root."""
    return f"""(1 - sqrt({x}) / 4000 / 3 * exp((1 - {dof} / 2.0) * ln(2) - lgamma({dof} / 2.0))
      * list_sum(list_transform(range(0, 4001), lambda i:
        (CASE WHEN i = 0 OR i = 4000 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
        * pow(sqrt({x}) * i / 4000.0, {dof} - 1) * exp(-{x} * pow(i / 4000.0, 2) / 2))))"""


def fisher_two_sided(a: str, b: str, c: str, d: str) -> str:
    """Sum of all tables with the same margins that are at most as likely as the observed one."""

    def weight(k: str) -> str:
        return (
            f"exp(-lgamma({k} + 1) - lgamma({a} + {b} - {k} + 1) - lgamma({a} + {c} - {k} + 1)"
            f" - lgamma({d} - {a} + {k} + 1) + lgamma({a} + {b} + 1) + lgamma({c} + {d} + 1)"
            f" + lgamma({a} + {c} + 1) + lgamma({b} + {d} + 1) - lgamma({a} + {b} + {c} + {d} + 1))"
        )

    low, high = f"greatest(0, {a} - {d})", f"least({a} + {b}, {a} + {c})"
    return f"""list_sum(list_transform(range(CAST({low} AS BIGINT), CAST({high} + 1 AS BIGINT)), lambda k:
      CASE WHEN {weight('k')} <= {weight(a)} * (1 + 1e-7) THEN {weight('k')} ELSE 0 END))"""


def newton_two(name: str, x: str, z: str, y: str, source: str) -> str:
    """Intercept and two slopes of a logistic fit by Newton steps over its patterns, with the information."""
    m = "(n * m * (1 - m))"
    return f""",
{name}_patterns AS (SELECT {x}::DOUBLE AS x, {z}::DOUBLE AS z, count(*)::DOUBLE AS n, sum({y})::DOUBLE AS s
  FROM {source} GROUP BY 1, 2),
{name}(i, a, b, c, v) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1,
    a + ((k22 * k33 - k23 * k23) * g1 + (k13 * k23 - k12 * k33) * g2 + (k12 * k23 - k13 * k22) * g3) / d,
    b + ((k13 * k23 - k12 * k33) * g1 + (k11 * k33 - k13 * k13) * g2 + (k12 * k13 - k11 * k23) * g3) / d,
    c + ((k12 * k23 - k13 * k22) * g1 + (k12 * k13 - k11 * k23) * g2 + (k11 * k22 - k12 * k12) * g3) / d,
    (k11 * k33 - k13 * k13) / d
  FROM (SELECT *, k11 * (k22 * k33 - k23 * k23) - k12 * (k12 * k33 - k13 * k23) + k13 * (k12 * k23 - k13 * k22) AS d
    FROM (SELECT i, a, b, c, sum(s - n * m) AS g1, sum((s - n * m) * x) AS g2, sum((s - n * m) * z) AS g3,
        sum({m}) AS k11, sum({m} * x) AS k12, sum({m} * z) AS k13, sum({m} * x * x) AS k22,
        sum({m} * x * z) AS k23, sum({m} * z * z) AS k33
      FROM (SELECT i, a, b, c, x, z, n, s, 1 / (1 + exp(-(a + b * x + c * z))) AS m
            FROM {name}, {name}_patterns WHERE i < 14) GROUP BY i, a, b, c)))"""


def newton(name: str, x: str, y: str, source: str, penalty: str = "0") -> str:
    """Intercept and slope of a logistic fit on one number, by Newton steps over its patterns.

    ``penalty`` is added to the slope's curvature (half the squared slope is penalised).
    """
    return f""",
{name}_patterns AS (SELECT {x} AS x, count(*)::DOUBLE AS n, sum({y})::DOUBLE AS s FROM {source} GROUP BY 1),
{name}(i, a, b, h11, h12, h22) AS (
  SELECT 0, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE, 0.0::DOUBLE
  UNION ALL
  SELECT i + 1, a + (k22 * g1 - k12 * g2) / (k11 * k22 - k12 * k12),
    b + (k11 * g2 - k12 * g1) / (k11 * k22 - k12 * k12), k11, k12, k22
  FROM (SELECT i, a, b, sum(s - n * m) AS g1, sum((s - n * m) * x) - {penalty} * b AS g2,
          sum(n * m * (1 - m)) AS k11, sum(n * m * (1 - m) * x) AS k12,
          sum(n * m * (1 - m) * x * x) + {penalty} AS k22
        FROM (SELECT i, a, b, x, n, s, 1 / (1 + exp(-(a + b * x))) AS m FROM {name}, {name}_patterns
              WHERE i < 14)
        GROUP BY i, a, b))"""
