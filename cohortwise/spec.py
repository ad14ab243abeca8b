"""What the columns of a cohort mean.

Column kinds are declared, never guessed from the physical type: every operator takes a
``CohortSpec`` (or the names it needs) and treats a column as continuous, binary or
categorical because the spec says so.
"""

from __future__ import annotations

from dataclasses import dataclass, field

CONTINUOUS = "continuous"
BINARY = "binary"
CATEGORICAL = "categorical"

# Spellings read as missing inside a table, and those that a reader of text files
# takes for missing before that.
MISSING_TOKENS = ("?", "")
READER_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


class AnalysisError(ValueError):
    """The request or the data does not allow the analysis."""


@dataclass(frozen=True)
class RangeRule:
    """A value is valid when it is null or inside the range."""

    column: str
    low: float | None = None
    high: float | None = None
    low_open: bool = False


@dataclass(frozen=True)
class CohortSpec:
    """Names and kinds of the columns of one cohort."""

    variables: dict[str, str]
    target: str
    raw_target: str | None = None
    low_label: str | None = None
    high_label: str | None = None
    raw_columns: tuple[str, ...] = ()
    numeric_columns: tuple[str, ...] = ()
    rules: tuple[RangeRule, ...] = ()
    missing_tokens: tuple[str, ...] = MISSING_TOKENS
    features: tuple[str, ...] = ()
    group_columns: tuple[str, ...] = ()
    key: str = "row_id"
    labels: dict[str, str] = field(default_factory=dict)

    def kind(self, column: str) -> str:
        if column not in self.variables:
            raise AnalysisError(f"'{column}' is not a registered analysis variable")
        kind = self.variables[column]
        if kind not in (CONTINUOUS, BINARY, CATEGORICAL):
            raise AnalysisError(f"variable '{column}' has unknown kind '{kind}'")
        return kind

    def split(self, columns) -> tuple[list[str], list[str]]:
        """Continuous columns, then binary and categorical ones."""
        unknown = [c for c in columns if c not in self.variables]
        if unknown:
            raise AnalysisError(f"unregistered variables: {unknown}")
        numeric = [c for c in columns if self.kind(c) == CONTINUOUS]
        return numeric, [c for c in columns if c not in numeric]


@dataclass(frozen=True)
class AnalysisRequest:
    """One association question: an exposure, its controls, and whether to match."""

    exposure: str
    controls: tuple[str, ...] = ()
    include_psm: bool = False


def census_spec() -> CohortSpec:
    """The census income table: fixed names, kinds, ranges and labels."""
    variables = {
        "age": CONTINUOUS,
        "workclass": CATEGORICAL,
        "education": CATEGORICAL,
        "marital-status": CATEGORICAL,
        "occupation": CATEGORICAL,
        "relationship": CATEGORICAL,
        "race": CATEGORICAL,
        "sex": BINARY,
        "capital-gain": CONTINUOUS,
        "capital-loss": CONTINUOUS,
        "hours-per-week": CONTINUOUS,
        "native-country": CATEGORICAL,
    }
    return CohortSpec(
        variables=variables,
        target="high_income",
        raw_target="income",
        low_label="<=50K",
        high_label=">50K",
        raw_columns=(
            "age", "workclass", "fnlwgt", "education", "education-num", "marital-status",
            "occupation", "relationship", "race", "sex", "capital-gain", "capital-loss",
            "hours-per-week", "native-country", "income",
        ),
        numeric_columns=(
            "age", "fnlwgt", "education-num", "capital-gain", "capital-loss", "hours-per-week",
        ),
        rules=(
            RangeRule("age", 1, 120),
            RangeRule("hours-per-week", 1, 168),
            RangeRule("education-num", 1, 20),
            RangeRule("fnlwgt", low=0, low_open=True),
            RangeRule("capital-gain", low=0),
            RangeRule("capital-loss", low=0),
        ),
        features=tuple(variables),
        group_columns=("sex", "race"),
    )
