"""Model terms of an exposure and its controls (L1-L3)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions.columns import col
from cohortwise.operators.unadjusted import levels_of
from cohortwise.spec import BINARY, CONTINUOUS, AnalysisError, AnalysisRequest, CohortSpec

INTERCEPT = "const"
RANK_TOLERANCE = 1e-12


@dataclass(frozen=True)
class Term:
    """One regression column: a number, or an indicator of ``level`` (its place in the levels)."""

    name: str
    column: str
    level: int | None = None


@dataclass(frozen=True)
class Design:
    """Terms in order (exposure first), the levels behind them, and what the data look like."""

    exposure: str
    kind: str
    terms: tuple[Term, ...]
    levels: dict[str, list[str]]
    scales: dict[str, float]
    rows: int
    positives: int
    repeats: bool

    @property
    def exposure_terms(self) -> list[Term]:
        return [t for t in self.terms if t.column == self.exposure]

    @property
    def names(self) -> list[str]:
        return [INTERCEPT, *[t.name for t in self.terms]]

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(t.column for t in self.terms))


def build_design(df: DataFrame, request: AnalysisRequest, spec: CohortSpec) -> Design:
    """Decide the terms from the levels and one aggregate over the complete cases.

    The first level of a variable in text order is the reference. Variables with a single
    value carry no information and give no term. Terms remember their variable, so a control
    whose name begins like the exposure is not mistaken for one of its levels.
    """
    columns = [request.exposure, *request.controls]
    measures = [F.count("*").alias("rows"), F.sum(col(spec.target).cast("int")).alias("positives")]
    for i, c in enumerate(columns):
        if spec.kind(c) == CONTINUOUS:
            value = col(c).cast("double")
            measures += [F.min(value).alias(f"min{i}"), F.max(value).alias(f"max{i}")]
    patterns = F.approx_count_distinct(F.xxhash64(*[col(c) for c in columns]))
    row = df.agg(*measures, patterns.alias("patterns")).first()
    dictionary = levels_of(df, [c for c in columns if spec.kind(c) != CONTINUOUS])

    terms, levels, scales = [], {}, {}
    for i, c in enumerate(columns):
        kind, is_exposure = spec.kind(c), c == request.exposure
        if kind == CONTINUOUS:
            low, high = row[f"min{i}"], row[f"max{i}"]
            if low is not None and low < high:
                terms.append(Term(c, c))
                scales[c] = max(abs(low), abs(high))
            elif is_exposure:
                raise AnalysisError(f"exposure '{c}' needs at least two distinct values")
            continue
        levels[c] = found = dictionary[c]
        if kind == BINARY:
            if len(found) > 2 or (is_exposure and len(found) != 2):
                raise AnalysisError(f"binary variable '{c}' has {len(found)} levels")
            if len(found) == 2:
                terms.append(Term(c, c, 1))
        else:
            if len(found) < 2 and is_exposure:
                raise AnalysisError(f"exposure '{c}' needs at least two levels")
            terms += [Term(f"{c}_{v}", c, j) for j, v in enumerate(found) if j > 0]
    if not any(t.column == request.exposure for t in terms):
        raise AnalysisError(f"no term is left for the exposure '{request.exposure}'")
    return Design(
        exposure=request.exposure,
        kind=spec.kind(request.exposure),
        terms=tuple(terms),
        levels=levels,
        scales=scales,
        rows=row.rows,
        positives=int(row.positives or 0),
        repeats=row.patterns * 2 <= row.rows,
    )


def term_value(term: Term, design: Design) -> Column:
    """The value of one term for a raw row."""
    if term.level is None:
        return col(term.column).cast("double")
    level = design.levels[term.column][term.level]
    return (col(term.column).cast("string") == level).cast("double")


def design_matrix(df: DataFrame, design: Design, keep: list[str] | None = None) -> DataFrame:
    """The kept columns followed by one double column per term."""
    return df.select(
        *[col(c) for c in keep or []],
        *[term_value(t, design).alias(t.name) for t in design.terms],
    )


def pattern_table(df: DataFrame, design: Design, target: str) -> DataFrame:
    """Codes of the predictors with the number of rows ``n`` and positives ``s``.

    A level becomes its place in the level list. Where many rows share a covariate pattern the
    rows are collapsed to patterns, which leaves the fit unchanged and shrinks every later pass.
    """

    def code(c: str) -> Column:
        if c not in design.levels:
            return col(c).cast("double")
        places = F.array(*[F.lit(v) for v in design.levels[c]])
        return (F.array_position(places, col(c).cast("string")) - 1).cast("double")

    y = col(target).cast("int")
    coded = df.select(
        *[code(c).alias(f"x{i}") for i, c in enumerate(design.columns)], y.alias("y")
    )
    names = [f"x{i}" for i in range(len(design.columns))]
    if design.repeats:
        return coded.groupBy(*names).agg(
            F.count("*").cast("double").alias("n"), F.sum("y").cast("double").alias("s")
        )
    return coded.select(*names, F.lit(1.0).alias("n"), F.col("y").cast("double").alias("s"))


def check_rank(gram: np.ndarray) -> None:
    """Raise when the columns behind a Gram matrix are linearly dependent."""
    size = np.sqrt(np.diag(gram))
    if np.any(size == 0):
        raise AnalysisError("a predictor is zero everywhere")
    values = np.linalg.eigvalsh(gram / np.outer(size, size))
    if values[0] < RANK_TOLERANCE * len(size):
        raise AnalysisError(
            "predictors are linearly dependent (collinear); remove controls that repeat others"
        )


