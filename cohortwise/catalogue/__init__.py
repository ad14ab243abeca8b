"""The registered queries, and SQL for those that SQL can express."""

from cohortwise.catalogue import cleaning, contracts, logistic, matching, metrics, prediction, unadjusted

_FAMILIES = (cleaning, unadjusted, metrics, logistic, matching, contracts, prediction)

QUERIES = {name: query for family in _FAMILIES for name, query in family.QUERIES.items()}
ORACLES = {name: text for family in _FAMILIES for name, text in family.ORACLES.items()}
