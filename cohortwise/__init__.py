"""Cohort association and risk scoring as DataFrame operators on Spark."""

from cohortwise.spec import (
    AnalysisError,
    AnalysisRequest,
    CohortSpec,
    RangeRule,
    census_spec,
)

__all__ = ["AnalysisError", "AnalysisRequest", "CohortSpec", "RangeRule", "census_spec"]
