"""Tail probabilities as column functions over summary rows.

Spark SQL has no error function or incomplete gamma/beta. These Arrow UDFs fill the gap for
result tables that hold one row per test; they are not meant for raw rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortwise.functions import special


def _vector(function, *series) -> pd.Series:
    out = [
        None if any(pd.isna(v) for v in values) else float(function(*values))
        for values in zip(*series, strict=True)
    ]
    return pd.Series(out, dtype="float64")


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return _vector(special.normal_two_sided, z)


@F.pandas_udf(T.DoubleType())
def chi2_sf(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _vector(special.chi2_sf, x, dof)


@F.pandas_udf(T.DoubleType())
def t_two_sided(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _vector(special.t_two_sided, t, dof)


@F.pandas_udf(T.DoubleType())
def fisher_two_sided(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    return _vector(lambda *v: special.fisher_two_sided(*map(int, v)), a, b, c, d)


@F.pandas_udf(T.DoubleType())
def mcnemar_exact(b: pd.Series, c: pd.Series) -> pd.Series:
    return _vector(lambda *v: special.binomial_half_two_sided(*map(int, v)), b, c)
