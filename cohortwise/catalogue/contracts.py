"""Queries for what is accepted and what is refused: paths, columns, requests, terms, records."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from cohortwise.catalogue import sql
from cohortwise.functions.columns import col
from cohortwise.operators import cleaning
from cohortwise.operators.design import build_design
from cohortwise.operators.logistic import fit_logistic
from cohortwise.plans import training
from cohortwise.session import scratch_folder
from cohortwise.sources import artefacts
from cohortwise.sources.tables import RAW_SPEC, TRADE_SPEC, raw_trade_text, trade_cohort
from cohortwise.spec import CONTINUOUS, AnalysisError, AnalysisRequest

OUTCOME = "state string, accepted boolean, n bigint, total double"


def _tried(state: str, attempt) -> tuple:
    """What an attempt counts, or that it was refused."""
    try:
        n, total = attempt()
    except AnalysisError:
        return state, False, None, None
    return state, True, n, total


def _discounts(df):
    return tuple(df.agg(F.count("*"), F.round(F.sum(F.col("discount").cast("double")), 4)).first())


def stored_paths(spark, folder):
    """A stored table is read, a path without data is refused."""
    path = scratch_folder(spark)
    raw_trade_text(spark, folder).write.csv(path, header=True)
    return spark.createDataFrame(
        [
            _tried("stored", lambda: _discounts(artefacts.read_raw_csv(spark, path, RAW_SPEC))),
            _tried("absent", lambda: _discounts(artefacts.read_raw_csv(spark, f"{path}/absent", RAW_SPEC))),
        ],
        OUTCOME,
    )


def column_contract(spark, folder):
    """Columns may come in any order; missing, further and repeated ones are refused."""
    stored = scratch_folder(spark)  # every table below is written from it
    raw_trade_text(spark, folder).write.parquet(stored)
    raw = spark.read.parquet(stored)
    names = raw.columns
    tables = {
        "as registered": raw,
        "reordered": raw.select(*reversed(names)),
        "without a column": raw.drop("segment"),
        "with a further column": raw.withColumn("further", F.lit("x")),
        "with a repeated column": raw.select(*names, F.col("segment").alias("other")).toDF(*names, "segment "),
    }
    found = []
    for state, df in tables.items():
        path = scratch_folder(spark)
        df.write.csv(path, header=True)
        found.append(_tried(state, lambda path=path: _discounts(artefacts.read_raw_csv(spark, path, RAW_SPEC))))
    return spark.createDataFrame(found, OUTCOME)


REQUESTS = {
    "one control": AnalysisRequest("segment", ("quantity",)),
    "matching": AnalysisRequest("exposed", ("quantity", "segment"), include_psm=True),
    "unknown exposure": AnalysisRequest("row_id", ("quantity",)),
    "unknown control": AnalysisRequest("segment", ("quantity", "row_id")),
    "exposure as control": AnalysisRequest("segment", ("segment",)),
    "control given twice": AnalysisRequest("segment", ("quantity", "quantity")),
    "absent column": AnalysisRequest("segment", ("nation",)),
    "matching of a categorical exposure": AnalysisRequest("segment", ("quantity",), include_psm=True),
    "matching without controls": AnalysisRequest("exposed", (), include_psm=True),
}


def request_validation(spark, folder):
    """Which requests are accepted, with the complete cases and their outcome."""
    rows = trade_cohort(spark, folder, ["outcome", "segment", "quantity", "exposed"]).persist()

    def attempt(request):
        cleaning.validate_request(rows, request, TRADE_SPEC)
        sample = cleaning.complete_cases(rows, [TRADE_SPEC.target, request.exposure, *request.controls])
        return tuple(sample.agg(F.count("*"), F.sum("outcome").cast("double")).first())

    return spark.createDataFrame([_tried(s, lambda r=r: attempt(r)) for s, r in REQUESTS.items()], OUTCOME)


def rank_check(spark, folder):
    """Controls that repeat others make no fit; ``accepted`` tells which pairs do."""
    rows = trade_cohort(spark, folder, ["outcome", "quantity", "discount", "exposed"]).select(
        "*", (2 * F.col("quantity") + 1).alias("twice"), F.when(F.col("exposed") == "yes", 1.0).otherwise(0.0).alias("coded")
    ).persist()
    spec = replace(TRADE_SPEC, variables={**TRADE_SPEC.variables, "twice": CONTINUOUS, "coded": CONTINUOUS})

    def attempt(exposure, control):
        fit_logistic(rows, build_design(rows, AnalysisRequest(exposure, (control,)), spec), "outcome")
        return tuple(rows.agg(F.count("*"), F.sum("outcome").cast("double")).first())

    pairs = [("quantity", "discount"), ("quantity", "twice"), ("exposed", "quantity"), ("exposed", "coded")]
    return spark.createDataFrame([_tried(f"{a} and {b}", lambda a=a, b=b: attempt(a, b)) for a, b in pairs], OUTCOME)


def _typed(spark, folder, columns):
    """Every column with its side of the registry's split, its distinct values and, of numbers, their sum."""
    rows = trade_cohort(spark, folder, list(columns))
    numeric, other = TRADE_SPEC.split(columns)
    entries = [
        F.struct(
            F.lit(c).alias("feature"), F.lit(c in numeric).alias("numeric"), F.count_distinct(col(c)).alias("n"),
            F.round(F.sum(col(c).cast("double")) if c in numeric else F.lit(None).cast("double"), 2).alias("total"),
        )
        for c in [*numeric, *other]
    ]
    return rows.agg(F.array(*entries).alias("found")).select(F.inline("found"))


def covariate_split(spark, folder):
    return _typed(spark, folder, COVARIATES)


def feature_types(spark, folder):
    return _typed(spark, folder, TRADE_SPEC.features)


COVARIATES = ("quantity", "exposed", "balance", "segment", "nation")
RECORD_SCHEMA = {"quantity": {}, "discount": {}, "segment": {}}


def record_columns(spark, folder):
    """Records must have exactly the features of the model besides their key."""
    rows = trade_cohort(spark, folder, ["row_id", *RECORD_SCHEMA, "balance"])
    tables = {
        "exact": rows.drop("balance"),
        "reordered": rows.select("segment", "discount", "quantity", "row_id"),
        "without a feature": rows.drop("balance", "segment"),
        "with a further column": rows,
    }

    def attempt(df):
        training.check_record_columns(df, RECORD_SCHEMA, "row_id")
        return _discounts(df)

    return spark.createDataFrame([_tried(s, lambda df=df: attempt(df)) for s, df in tables.items()], OUTCOME)


QUERIES = {
    "s2_stored_paths": stored_paths,
    "s3_column_contract": column_contract,
    "c10_request_validation": request_validation,
    "l3_rank_check": rank_check,
    "m1_covariate_split": covariate_split,
    "p1_feature_types": feature_types,
    "p15_record_columns": record_columns,
}


def _states(source: str, total: str, accepted: list[str], refused: list[str]) -> str:
    """Accepted states with what the table holds, refused ones without."""
    parts = [f"SELECT '{s}' AS state, true AS accepted, count(*) AS n, {total} AS total FROM {source}" for s in accepted]
    parts += [f"SELECT '{s}', false, NULL, NULL" for s in refused]
    return " UNION ALL ".join(parts)


_DISCOUNT = "round(sum(CAST(discount AS DOUBLE)), 4)"


def _types_sql(columns) -> str:
    kinds = ("DOUBLE", "INTEGER", "BIGINT", "DECIMAL(15,2)")
    return sql.with_(sql.COHORT) + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, any_value(typeof({c}) IN {kinds}) AS numeric, count(DISTINCT {c}) AS n,
        round(sum(TRY_CAST({c} AS DOUBLE)), 2) AS total FROM cohort"""
        for c in columns
    )


_RANK_PAIRS = """,
pairs AS (SELECT quantity, discount, 2 * quantity + 1 AS twice, CASE WHEN exposed = 'yes' THEN 1.0 ELSE 0.0 END AS coded,
    outcome FROM cohort),
  judged AS (SELECT count(*) AS n, sum(outcome)::DOUBLE AS total, corr(quantity, discount) AS a, corr(quantity, twice) AS b,
    corr(coded, quantity) AS c, corr(coded, coded) AS d FROM pairs),
  listed AS (SELECT 'quantity and discount' AS state, a AS r, n, total FROM judged UNION ALL SELECT 'quantity and twice', b, n, total FROM judged
    UNION ALL SELECT 'exposed and quantity', c, n, total FROM judged UNION ALL SELECT 'exposed and coded', d, n, total FROM judged)"""
_RANK = """SELECT state, abs(r) < 1 - 1e-9 AS accepted, CASE WHEN abs(r) < 1 - 1e-9 THEN n END AS n,
    CASE WHEN abs(r) < 1 - 1e-9 THEN total END AS total FROM listed"""

ORACLES = {
    "s2_stored_paths": sql.with_(sql.RAW) + _states("raw", _DISCOUNT, ["stored"], ["absent"]),
    "s3_column_contract": sql.with_(sql.RAW)
    + _states(
        "raw", _DISCOUNT, ["as registered", "reordered"],
        ["without a column", "with a further column", "with a repeated column"],
    ),
    "c10_request_validation": sql.with_(sql.COHORT)
    + _states("cohort", "sum(outcome)::DOUBLE", list(REQUESTS)[:2], list(REQUESTS)[2:]),
    "l3_rank_check": sql.with_(sql.COHORT + _RANK_PAIRS) + _RANK,
    "m1_covariate_split": _types_sql(COVARIATES),
    "p1_feature_types": _types_sql(TRADE_SPEC.features),
    "p15_record_columns": sql.with_(sql.COHORT)
    + _states("cohort", _DISCOUNT, ["exact", "reordered"], ["without a feature", "with a further column"]),
}
