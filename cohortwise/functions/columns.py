"""Column expressions used by several operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
WHITESPACE = " \t\n\r\x0b\x0c"
FLOAT_TYPES = (T.DoubleType, T.FloatType)


def col(name: str) -> Column:
    """A column by its exact name; hyphens and dots need quoting."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN for floating point columns."""
    c = col(name)
    if isinstance(df.schema[name].dataType, FLOAT_TYPES):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def all_true(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__and__, conditions)


def any_true(conditions: Iterable[Column]) -> Column:
    return reduce(Column.__or__, conditions)


def rate(numerator: Column, denominator: Column, empty: float | None = None) -> Column:
    """numerator / denominator as a double, ``empty`` where the denominator is zero."""
    safe = F.when(denominator != 0, numerator.cast("double") / denominator)
    return safe if empty is None else F.coalesce(safe, F.lit(float(empty)))


def sigmoid(eta: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-eta))


def finite_or_null(c: Column) -> Column:
    """Values that JSON cannot carry become null."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(None)).otherwise(c)


def hash_uniform(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends only on the key and the salt."""
    digest = F.md5(F.concat(key, F.lit(":" + salt)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)


def require_columns(df: DataFrame, names: Iterable[str], what: str) -> None:
    from cohortwise.spec import AnalysisError

    absent = [n for n in names if n not in df.columns]
    if absent:
        raise AnalysisError(f"{what}: missing columns {absent}")
