"""The registered queries of this package, and SQL for those that SQL can express."""

from __future__ import annotations

from cohortwise.llm import (
    chat_query,
    filter_audit_query,
    language_query,
    lm_query,
    mixing_query,
    near_dedup_query,
    packing_query,
    phrase_query,
    pii_query,
    quality_query,
    stripes_query,
    token_files_query,
    toxicity_query,
)

_MODULES = (
    token_files_query,
    quality_query,
    phrase_query,
    language_query,
    toxicity_query,
    packing_query,
    near_dedup_query,
    mixing_query,
    pii_query,
    lm_query,
    chat_query,
    stripes_query,
    filter_audit_query,
)

QUERIES = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: text for m in _MODULES for name, text in m.ORACLES.items()}
