"""Normalising, coercing, validating and filtering cohort rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions.columns import (
    NUMERIC_TEXT,
    WHITESPACE,
    all_true,
    any_true,
    col,
    is_missing,
    require_columns,
)
from cohortwise.spec import (
    BINARY,
    CONTINUOUS,
    AnalysisError,
    AnalysisRequest,
    CohortSpec,
    RangeRule,
)

MIN_ROWS_PER_CLASS = 10


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def normalise_strings(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """Trim text, turn missing-value spellings into null, strip dots after target labels."""

    def clean(name: str) -> Column:
        text = F.trim(col(name), F.lit(WHITESPACE))
        text = F.when(text.isin(*spec.missing_tokens), F.lit(None)).otherwise(text)
        return F.rtrim(text, F.lit(".")) if name == spec.raw_target else text

    text_names = set(string_columns(df))
    return df.select(
        *[clean(n).alias(n) if n in text_names else col(n) for n in df.columns]
    )


def to_number(c: Column) -> Column:
    """Text as a double, null where it is not a decimal number.

    The pattern keeps out what the cast alone would take, such as hexadecimal or ``1d``.
    """
    text = c.cast("string")
    return F.when(text.rlike(NUMERIC_TEXT), text.try_cast("double"))


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Make the columns doubles; text that does not parse, and NaN, become null."""
    columns = set(columns)

    def convert(name: str) -> Column:
        if name not in columns:
            return col(name)
        if name in text_names:
            return to_number(col(name)).alias(name)
        return F.nanvl(col(name).cast("double"), F.lit(None).cast("double")).alias(name)

    text_names = set(string_columns(df))
    return df.select(*[convert(n) for n in df.columns])


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each set of equal rows; nulls are equal to each other."""
    return df.dropDuplicates()


def rule_condition(rule: RangeRule) -> Column:
    c = col(rule.column)
    checks = []
    if rule.low is not None:
        checks.append(c > rule.low if rule.low_open else c >= rule.low)
    if rule.high is not None:
        checks.append(c <= rule.high)
    # A comparison with null is null: such a row counts as valid.
    return F.coalesce(all_true(checks), F.lit(True))


def valid_row(spec: CohortSpec) -> Column:
    """True where every value is null or inside its declared range or label set."""
    checks = [rule_condition(rule) for rule in spec.rules]
    if spec.raw_target is not None:
        known = col(spec.raw_target).isin(spec.low_label, spec.high_label)
        checks.append(F.coalesce(known, F.lit(True)))
    return all_true(checks)


def filter_valid(df: DataFrame, spec: CohortSpec) -> DataFrame:
    return df.filter(valid_row(spec))


def target_from_label(spec: CohortSpec) -> Column:
    label = col(spec.raw_target)
    return (
        F.when(label == spec.low_label, F.lit(0))
        .when(label == spec.high_label, F.lit(1))
        .cast("int")
    )


def derive_target(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """Add the 0/1 target; a missing or unknown label gives null."""
    return df.withColumn(spec.target, target_from_label(spec))


def _distinct_with_copies(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """Tidy rows once each, how often they occur, and whether they are valid.

    Validity is an aggregate: as a filter on the keys it would be pushed below the projection
    and repeat the text work of every column it tests.
    """
    tidy = coerce_numeric(normalise_strings(df, spec), spec.numeric_columns)
    return tidy.groupBy(*[col(n) for n in tidy.columns]).agg(
        F.count("*").alias("__copies"), F.every(valid_row(spec)).alias("__valid")
    )


def clean(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """Normalise, coerce, de-duplicate, drop invalid rows, derive the target."""
    rows = _distinct_with_copies(df, spec).filter("__valid").drop("__copies", "__valid")
    return derive_target(rows, spec)


def cleaning_audit(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """One row of counts for ``clean``: the same single shuffle, read for its copy counts."""
    rows = _distinct_with_copies(df, spec)
    columns = [n for n in rows.columns if not n.startswith("__")]
    ok, copies = F.col("__valid"), F.col("__copies")
    incomplete = any_true(col(n).isNull() for n in columns)
    count = F.count("*")
    return rows.agg(
        F.coalesce(F.sum(copies), F.lit(0)).cast("bigint").alias("initial_rows"),
        F.coalesce(F.sum(F.when(incomplete, copies)), F.lit(0)).cast("bigint")
        .alias("rows_with_missing"),
        F.coalesce(F.sum(copies - 1), F.lit(0)).cast("bigint").alias("duplicate_removed"),
        (count - F.count_if(ok)).alias("invalid_removed"),
        F.count_if(ok).alias("rows_after_cleaning"),
        F.lit(len(columns) + 1).cast("bigint").alias("columns_after_cleaning"),
    )


def clean_with_audit(df: DataFrame, spec: CohortSpec) -> tuple[DataFrame, dict[str, int]]:
    """The cleaned rows and their audit; an empty input is an error."""
    audit = cleaning_audit(df, spec).first().asDict()
    if audit["initial_rows"] == 0:
        raise AnalysisError("there are no rows to clean")
    return clean(df, spec), audit


def complete_cases(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns, once each, without rows that miss any of them."""
    names = list(dict.fromkeys(columns))
    require_columns(df, names, "complete cases")
    return df.select(*[col(n) for n in names]).na.drop()


def validate_profile_input(df: DataFrame, target: str) -> None:
    duplicated = sorted({n for n in df.columns if df.columns.count(n) > 1})
    if duplicated:
        raise AnalysisError(f"duplicate column names: {duplicated}")
    require_columns(df, [target], "profile")
    t = col(target)
    row = df.agg(
        F.count("*").alias("n"),
        F.count_if(t.isNotNull() & ~t.isin(0, 1)).alias("bad"),
    ).first()
    if row.n == 0:
        raise AnalysisError("there are no rows to profile")
    if row.bad:
        raise AnalysisError(f"target '{target}' holds {row.bad} values other than 0, 1 and null")


def outcome_state(df: DataFrame, target: str) -> DataFrame:
    """One row: how many outcomes are 0, 1, null or something else, and whether that is usable."""
    t = to_number(col(target))
    zeros, ones = F.count_if(t == 0), F.count_if(t == 1)
    other = F.count_if(col(target).isNotNull() & ~F.coalesce(t.isin(0.0, 1.0), F.lit(False)))
    return df.agg(
        zeros.alias("zeros"),
        ones.alias("ones"),
        F.count_if(col(target).isNull()).alias("missing"),
        other.alias("other"),
        ((zeros > 0) & (ones > 0) & (other == 0)).alias("usable"),
    )


def validate_binary_outcome(df: DataFrame, target: str) -> int:
    """Require both 0 and 1 and nothing else; return the number of non-null outcomes."""
    row = outcome_state(df, target).first()
    if not row.usable:
        raise AnalysisError(
            f"outcome '{target}' must hold both 0 and 1 and nothing else "
            f"(0: {row.zeros}, 1: {row.ones}, other: {row.other})"
        )
    return row.zeros + row.ones


def validate_request(df: DataFrame, request: AnalysisRequest, spec: CohortSpec) -> None:
    if request.exposure not in spec.variables:
        raise AnalysisError(f"'{request.exposure}' cannot be used as an exposure")
    bad = [c for c in request.controls if c not in spec.variables]
    if bad:
        raise AnalysisError(f"not usable as controls: {bad}")
    if request.exposure in request.controls:
        raise AnalysisError(f"exposure '{request.exposure}' is also a control")
    if len(set(request.controls)) != len(request.controls):
        raise AnalysisError("a control is given twice")
    require_columns(df, [spec.target, request.exposure, *request.controls], "association")
    if request.include_psm:
        if spec.kind(request.exposure) != BINARY:
            raise AnalysisError("matching needs a binary exposure")
        if not request.controls:
            raise AnalysisError("matching needs at least one control")


def class_sizes(df: DataFrame, target: str) -> DataFrame:
    """Rows per known class and whether the class is large enough to train on."""
    return (
        df.filter(col(target).isNotNull())
        .groupBy(col(target).cast("int").alias("target"))
        .agg(F.count("*").alias("n"))
        .withColumn("enough", F.col("n") >= MIN_ROWS_PER_CLASS)
    )


def select_training_rows(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """Rows with a known outcome; both classes must be present and large enough."""
    require_columns(df, [spec.target, *spec.features], "training")
    sizes = {r.target: r.n for r in class_sizes(df, spec.target).collect()}
    if set(sizes) != {0, 1}:
        raise AnalysisError(f"training needs both classes 0 and 1, found {sorted(sizes)}")
    small = {k: n for k, n in sizes.items() if n < MIN_ROWS_PER_CLASS}
    if small:
        raise AnalysisError(f"classes with fewer than {MIN_ROWS_PER_CLASS} rows: {small}")
    return df.filter(col(spec.target).isNotNull())


def feature_violations(df: DataFrame, schema: dict, features: Iterable[str]) -> DataFrame:
    """Values a model input schema cannot take: ``feature, bad_value, n``."""
    checks = []
    for name in features:
        text, info = col(name).cast("string"), schema[name]
        if info["kind"] == CONTINUOUS:
            bad = to_number(col(name)).isNull()
        else:
            bad = ~text.isin(*info["levels"])
        checks.append(
            F.struct(F.lit(name).alias("feature"), F.when(bad, text).alias("bad_value"))
        )
    return (
        df.select(F.explode(F.array(*checks)).alias("v"))
        .select("v.feature", "v.bad_value")
        .filter(F.col("bad_value").isNotNull())
        .groupBy("feature", "bad_value")
        .agg(F.count("*").alias("n"))
    )


def coerce_features(
    df: DataFrame, schema: dict, features: Iterable[str], allow_unknown: bool = False
) -> DataFrame:
    """Bring features to the types and levels of the schema.

    Numbers that do not parse are an error. Unseen levels are an error too, or null where
    ``allow_unknown`` is set.
    """
    features = list(features)
    require_columns(df, features, "model input")
    strict = [f for f in features if not allow_unknown or schema[f]["kind"] == CONTINUOUS]
    text_strict = [
        f for f in strict
        if schema[f]["kind"] != CONTINUOUS or isinstance(df.schema[f].dataType, T.StringType)
    ]
    if text_strict:
        bad = feature_violations(df, schema, text_strict).limit(20).collect()
        if bad:
            raise AnalysisError(
                "values the model cannot take: "
                + ", ".join(f"{r.feature}={r.bad_value!r} ({r.n})" for r in bad)
            )

    def convert(name: str) -> Column:
        if name not in features:
            return col(name)
        info = schema[name]
        if info["kind"] == CONTINUOUS:
            return to_number(col(name)).alias(name)
        text = col(name).cast("string")
        return F.when(text.isin(*info["levels"]), text).alias(name)

    return df.select(*[convert(n) for n in df.columns])


def prepare_prediction_rows(df: DataFrame, schema: dict, features: Iterable[str]) -> DataFrame:
    """Strict coercion of a non-empty batch of records."""
    if df.isEmpty():
        raise AnalysisError("there are no rows to predict")
    return coerce_features(df, schema, features)


def prediction_table_checks(df: DataFrame) -> DataFrame:
    """One row of counts describing a table with ``y_test, y_pred, y_proba``."""
    y, yhat, p = col("y_test"), col("y_pred"), col("y_proba")
    bad_p = p.isNull() | F.isnan(p) | (p < 0) | (p > 1)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(y == 0).alias("negatives"),
        F.count_if(y == 1).alias("positives"),
        F.count_if(y.isNull() | ~y.isin(0, 1)).alias("bad_outcomes"),
        F.count_if(yhat.isNull() | ~yhat.isin(0, 1)).alias("bad_classes"),
        F.count_if(bad_p).alias("bad_probabilities"),
    )


def validate_prediction_table(df: DataFrame) -> None:
    require_columns(df, ["y_test", "y_pred", "y_proba"], "prediction table")
    row = prediction_table_checks(df).first()
    if row.rows == 0:
        raise AnalysisError("the prediction table is empty")
    if not row.negatives or not row.positives or row.bad_outcomes:
        raise AnalysisError("y_test must hold both 0 and 1 and nothing else")
    if row.bad_classes:
        raise AnalysisError("y_pred must hold only 0 and 1")
    if row.bad_probabilities:
        raise AnalysisError("y_proba must be finite and between 0 and 1")
