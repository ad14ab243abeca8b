"""Queries for cleaning, validation and profiling (C, E, S5, S6, S11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.operators import cleaning as ops
from cohortwise.operators import profiling
from cohortwise.sources.tables import (
    RAW_SPEC,
    raw_trade_text,
    review_cohort,
    trade_cohort,
)

RAW_COLUMNS = ["order_key", "quantity", "discount", "segment", "return_flag", "price_class"]


def _coerced(spark, folder):
    tidy = ops.normalise_strings(raw_trade_text(spark, folder), RAW_SPEC)
    return ops.coerce_numeric(tidy, RAW_SPEC.numeric_columns)


def _profiled(spark, folder):
    return ops.derive_target(_coerced(spark, folder), RAW_SPEC)


def _rounded(df, *names, digits=6):
    for name in names:
        df = df.withColumn(name, F.round(name, digits) + 0.0)
    return df


def normalise(spark, folder):
    tidy = ops.normalise_strings(raw_trade_text(spark, folder), RAW_SPEC)
    return tidy.groupBy(*RAW_COLUMNS).agg(F.count("*").alias("n"))


def coerce(spark, folder):
    return _coerced(spark, folder).groupBy("quantity", "discount").agg(F.count("*").alias("n"))


def deduplicate(spark, folder):
    return ops.drop_exact_duplicates(_coerced(spark, folder))


def range_filter(spark, folder):
    kept = ops.filter_valid(_coerced(spark, folder), RAW_SPEC)
    return kept.groupBy("quantity", "price_class").agg(F.count("*").alias("n"))


def clean_rows(spark, folder):
    return ops.clean(raw_trade_text(spark, folder), RAW_SPEC)


def audit(spark, folder):
    return ops.cleaning_audit(raw_trade_text(spark, folder), RAW_SPEC)


def target(spark, folder):
    return _profiled(spark, folder).groupBy("price_class", "high_value").agg(F.count("*").alias("n"))


def complete(spark, folder):
    rows = ops.complete_cases(
        _profiled(spark, folder), ["high_value", "segment", "quantity", "segment"]
    )
    return rows.groupBy("high_value", "segment", "quantity").agg(F.count("*").alias("n"))


def outcome_state(spark, folder):
    return ops.outcome_state(_profiled(spark, folder), "high_value")


def training_classes(spark, folder):
    return ops.class_sizes(_profiled(spark, folder), "high_value")


SEGMENT_SCHEMA = {
    "quantity": {"kind": "continuous"},
    "segment": {"kind": "categorical", "levels": ["AUTOMOBILE", "BUILDING", "MACHINERY"]},
}


def violations(spark, folder):
    tidy = ops.normalise_strings(raw_trade_text(spark, folder), RAW_SPEC)
    return ops.feature_violations(tidy, SEGMENT_SCHEMA, ["quantity", "segment"])


def lenient_features(spark, folder):
    rows = ops.coerce_features(_coerced(spark, folder), SEGMENT_SCHEMA, ["quantity", "segment"], True)
    return rows.groupBy("segment").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


def strict_batch(spark, folder):
    schema = {
        "quantity": {"kind": "continuous"},
        "return_flag": {"kind": "categorical", "levels": ["A", "N", "R"]},
    }
    rows = trade_cohort(spark, folder, ["quantity", "return_flag"])
    ready = ops.prepare_prediction_rows(rows, schema, ["quantity", "return_flag"])
    return ready.groupBy("return_flag").agg(F.count("*").alias("n"), F.sum("quantity").alias("quantity"))


def prediction_checks(spark, folder):
    rows = trade_cohort(spark, folder, ["outcome", "predicted", "score"]).toDF(
        "y_test", "y_pred", "y_proba"
    )
    return ops.prediction_table_checks(rows)


def missing(spark, folder):
    return _rounded(profiling.missing_values(_profiled(spark, folder)), "missing_rate")


def duplicates(spark, folder):
    return _rounded(profiling.duplicate_summary(_profiled(spark, folder)), "duplicate_rate")


def describe(spark, folder):
    found = profiling.describe_numeric(_profiled(spark, folder).persist())
    return _rounded(found, "mean", "std", "min", "q1", "median", "q3", "max")


def frequencies(spark, folder):
    return _rounded(profiling.category_frequencies(_profiled(spark, folder)), "proportion")


def target_summary(spark, folder):
    return _rounded(profiling.target_summary(_profiled(spark, folder), "high_value"), "high_rate")


def overview(spark, folder):
    return _rounded(profiling.profile_overview(_profiled(spark, folder), "high_value"), "high_rate")


def full_profile(spark, folder):
    """Every number of all profile tables of the labelled documents: section, item, measure, value."""
    tables = profiling.full_profile(review_cohort(spark, folder), "quality")
    parts = []
    for section, t in tables.items():
        names = [F.col(f"`{c}`") for c in ("column", "category") if c in t.columns]
        numbers = [c for c, kind in t.dtypes if kind != "string"]
        values = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value")) for c in numbers])
        parts.append(t.select(F.lit(section).alias("section"), F.concat_ws("=", *names).alias("item"), F.inline(values)))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return _rounded(whole, "value")


def serialisable(spark, folder):
    from cohortwise.sources.artefacts import serialisable

    rows = trade_cohort(spark, folder, ["quantity", "discount", "return_flag"])
    ratio = F.when(F.col("discount") > 0, F.col("quantity") / F.col("discount")).otherwise(
        F.when(F.col("quantity") > 25, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    )
    clean = serialisable(rows.withColumn("ratio", ratio))
    return clean.groupBy("return_flag").agg(
        F.count("*").alias("n"),
        F.count("ratio").alias("finite"),
        F.round(F.sum("ratio"), 4).alias("total"),
    )


QUERIES = {
    "c1_normalise_strings": normalise,
    "c2_coerce_numeric": coerce,
    "c3_exact_duplicates": deduplicate,
    "c4_range_filter": range_filter,
    "c5_clean_rows": clean_rows,
    "c5_cleaning_audit": audit,
    "c6_target": target,
    "c7_complete_cases": complete,
    "c9_outcome_state": outcome_state,
    "c11_training_classes": training_classes,
    "c12_feature_violations": violations,
    "c12_lenient_features": lenient_features,
    "c13_strict_batch": strict_batch,
    "c14_prediction_checks": prediction_checks,
    "e1_missing_values": missing,
    "e2_duplicates": duplicates,
    "e3_describe_numeric": describe,
    "e4_category_frequencies": frequencies,
    "e5_target_summary": target_summary,
    "e6_profile_overview": overview,
    "e6_full_profile": full_profile,
    "s11_serialisable": serialisable,
}

_TYPES = {"quantity": "double", "discount": "double", "high_value": "int"}
_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in RAW_COLUMNS)
_ALL = ", ".join(RAW_COLUMNS)


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", count({column}) AS count, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS std, round(min({column})::DOUBLE, 6) AS min,
      round(quantile_cont({column}, 0.25)::DOUBLE, 6) AS q1,
      round(quantile_cont({column}, 0.5)::DOUBLE, 6) AS median,
      round(quantile_cont({column}, 0.75)::DOUBLE, 6) AS q3,
      round(max({column})::DOUBLE, 6) AS max, count(*) - count({column}) AS missing_count FROM profiled"""


def _frequency_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", coalesce({column}, '<NA>') AS category, count(*) AS count,
      round(count(*) / (SELECT count(*) FROM profiled)::DOUBLE, 6) AS proportion
      FROM profiled GROUP BY 2"""


def _profile_sql() -> str:
    names, numeric, texts = ["doc_id", "quality", "n_chars", "toxic", "lang", "source"], ["doc_id", "quality", "n_chars"], ["toxic", "lang", "source"]
    gaps = " + ".join(f"count(*) - count({c})" for c in names)
    holes = " + ".join(f"(count(*) > count({c}))::INTEGER" for c in names)
    repeated = f"(SELECT coalesce(sum(n - 1), 0) FROM (SELECT count(*) AS n FROM review GROUP BY {', '.join(names)})) + 0 * count(*)"
    measures = {
        ("overview", "''"): {
            "rows": "count(*)", "columns": "6 + 0 * count(*)", "missing_cells": gaps, "columns_with_missing": holes,
            "duplicate_rows": repeated, "valid_targets": "count(quality)",
            "high_count": "count(*) FILTER (WHERE quality = 1)", "high_rate": "avg(quality)",
        },
        ("target", "''"): {
            "valid_count": "count(quality)", "missing_count": "count(*) - count(quality)",
            "low_count": "count(*) FILTER (WHERE quality = 0)", "high_count": "count(*) FILTER (WHERE quality = 1)",
            "high_rate": "avg(quality)",
        },
        ("duplicates", "''"): {
            "row_count": "count(*)", "duplicate_rows": repeated, "duplicate_rate": f"({repeated}) / count(*)::DOUBLE",
        },
    }
    for c in names:
        measures["missing", f"'{c}'"] = {
            "missing_count": f"count(*) - count({c})", "missing_rate": f"(count(*) - count({c})) / count(*)::DOUBLE",
        }
    for c in numeric:
        measures["numeric", f"'{c}'"] = {
            "count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})",
            "q1": f"quantile_cont({c}::DOUBLE, 0.25)", "median": f"quantile_cont({c}::DOUBLE, 0.5)",
            "q3": f"quantile_cont({c}::DOUBLE, 0.75)", "max": f"max({c})", "missing_count": f"count(*) - count({c})",
        }
    one = [
        f"SELECT '{section}' AS section, {item} AS item, '{m}' AS measure, round(({v})::DOUBLE, 6) AS value FROM review"
        for (section, item), parts in measures.items() for m, v in parts.items()
    ]
    many = [
        f"SELECT 'categories', '{c}=' || coalesce({c}, '<NA>'), '{m}', round(({v})::DOUBLE, 6) FROM review GROUP BY 2"
        for c in texts
        for m, v in (("count", "count(*)"), ("proportion", "count(*) / (SELECT count(*) FROM review)::DOUBLE"))
    ]
    return _union(one + many)


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


ORACLES = {
    "c1_normalise_strings": sql.with_(sql.NORMALISED)
    + f"SELECT {_ALL}, count(*) AS n FROM normalised GROUP BY ALL",
    "c2_coerce_numeric": sql.with_(sql.COERCED)
    + "SELECT quantity, discount, count(*) AS n FROM coerced GROUP BY ALL",
    "c3_exact_duplicates": sql.with_(sql.COERCED) + "SELECT DISTINCT * FROM coerced",
    "c4_range_filter": sql.with_(sql.COERCED)
    + f"SELECT quantity, price_class, count(*) AS n FROM coerced WHERE {sql.VALID} GROUP BY ALL",
    "c5_clean_rows": sql.with_(sql.COERCED)
    + f"SELECT DISTINCT *, {sql.TARGET} AS high_value FROM coerced WHERE {sql.VALID}",
    "c5_cleaning_audit": sql.with_(sql.COERCED)
    + f"""SELECT (SELECT count(*) FROM coerced) AS initial_rows,
      (SELECT count(*) FROM coerced WHERE {_ANY_NULL}) AS rows_with_missing,
      (SELECT count(*) FROM coerced) - count(*) AS duplicate_removed,
      count(*) FILTER (WHERE NOT ({sql.VALID})) AS invalid_removed,
      count(*) FILTER (WHERE {sql.VALID}) AS rows_after_cleaning,
      CAST(7 AS BIGINT) AS columns_after_cleaning FROM (SELECT DISTINCT * FROM coerced)""",
    "c6_target": sql.with_(sql.PROFILED)
    + "SELECT price_class, high_value, count(*) AS n FROM profiled GROUP BY ALL",
    "c7_complete_cases": sql.with_(sql.PROFILED)
    + """SELECT high_value, segment, quantity, count(*) AS n FROM profiled
      WHERE high_value IS NOT NULL AND segment IS NOT NULL AND quantity IS NOT NULL GROUP BY ALL""",
    "c9_outcome_state": sql.with_(sql.PROFILED)
    + """SELECT count(*) FILTER (WHERE high_value = 0) AS zeros,
      count(*) FILTER (WHERE high_value = 1) AS ones,
      count(*) FILTER (WHERE high_value IS NULL) AS missing, CAST(0 AS BIGINT) AS other,
      true AS usable FROM profiled""",
    "c11_training_classes": sql.with_(sql.PROFILED)
    + """SELECT high_value AS target, count(*) AS n, count(*) >= 10 AS enough FROM profiled
      WHERE high_value IS NOT NULL GROUP BY 1""",
    "c12_feature_violations": sql.with_(sql.NORMALISED)
    + """SELECT 'quantity' AS feature, quantity AS bad_value, count(*) AS n FROM normalised
      WHERE quantity IS NOT NULL AND TRY_CAST(quantity AS DOUBLE) IS NULL GROUP BY 2
      UNION ALL SELECT 'segment', segment, count(*) FROM normalised
      WHERE segment NOT IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') GROUP BY 2""",
    "c12_lenient_features": sql.with_(sql.COERCED)
    + """SELECT CASE WHEN segment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY') THEN segment END AS segment,
      count(*) AS n, sum(quantity) AS quantity FROM coerced GROUP BY 1""",
    "c13_strict_batch": """SELECT l_returnflag AS return_flag, count(*) AS n, sum(l_quantity) AS quantity
      FROM lineitem GROUP BY 1""",
    "c14_prediction_checks": sql.with_(sql.COHORT)
    + """SELECT count(*) AS rows, count(*) FILTER (WHERE outcome = 0) AS negatives,
      count(*) FILTER (WHERE outcome = 1) AS positives, CAST(0 AS BIGINT) AS bad_outcomes,
      count(*) FILTER (WHERE predicted NOT IN (0, 1)) AS bad_classes,
      count(*) FILTER (WHERE score < 0 OR score > 1) AS bad_probabilities FROM cohort""",
    "e1_missing_values": sql.with_(sql.PROFILED)
    + _union(
        f"""SELECT '{c}' AS "column", '{_TYPES.get(c, 'string')}' AS dtype, count(*) - count({c}) AS missing_count,
        round((count(*) - count({c})) / count(*)::DOUBLE, 6) AS missing_rate FROM profiled"""
        for c in [*RAW_COLUMNS, "high_value"]
    ),
    "e2_duplicates": sql.with_(sql.PROFILED)
    + """SELECT sum(n)::BIGINT AS row_count, sum(n - 1)::BIGINT AS duplicate_rows,
      round(sum(n - 1) / sum(n)::DOUBLE, 6) AS duplicate_rate
      FROM (SELECT count(*) AS n FROM profiled GROUP BY order_key, quantity, discount, segment,
            return_flag, price_class, high_value)""",
    "e3_describe_numeric": sql.with_(sql.PROFILED)
    + _union(_describe_sql(c) for c in ("quantity", "discount", "high_value")),
    "e4_category_frequencies": sql.with_(sql.PROFILED)
    + _union(_frequency_sql(c) for c in ("order_key", "segment", "return_flag", "price_class")),
    "e5_target_summary": sql.with_(sql.PROFILED)
    + """SELECT count(high_value) AS valid_count, count(*) - count(high_value) AS missing_count,
      count(*) FILTER (WHERE high_value = 0) AS low_count,
      count(*) FILTER (WHERE high_value = 1) AS high_count,
      round(avg(high_value), 6) AS high_rate FROM profiled""",
    "e6_full_profile": sql.with_(sql.REVIEW) + _profile_sql(),
    "e6_profile_overview": sql.with_(sql.PROFILED)
    + f"""SELECT count(*) AS rows, CAST(7 AS BIGINT) AS columns,
      ({" + ".join(f"(count(*) - count({c}))" for c in [*RAW_COLUMNS, "high_value"])})::BIGINT
        AS missing_cells,
      ({" + ".join(f"CAST(count(*) > count({c}) AS INTEGER)" for c in [*RAW_COLUMNS, "high_value"])})::BIGINT
        AS columns_with_missing,
      (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM profiled)))::BIGINT AS duplicate_rows,
      count(high_value) AS valid_targets, count(*) FILTER (WHERE high_value = 1) AS high_count,
      round(avg(high_value), 6) AS high_rate FROM profiled""",
    "s11_serialisable": """SELECT l_returnflag AS return_flag, count(*) AS n,
      count(*) FILTER (WHERE l_discount > 0) AS finite,
      round(sum(l_quantity / l_discount) FILTER (WHERE l_discount > 0), 4) AS total
      FROM lineitem GROUP BY 1""",
}

