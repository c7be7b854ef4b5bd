"""All registered queries and their oracle SQL."""

from __future__ import annotations

from . import (
    oracle_business,
    oracle_features,
    oracle_learned,
    oracle_models,
    oracle_outlook,
    oracle_profile,
    query_business,
    query_features,
    query_learned,
    query_models,
    query_outlook,
    query_profile,
)

QUERIES = {
    **query_business.QUERIES, **query_profile.QUERIES, **query_features.QUERIES, **query_models.QUERIES, **query_learned.QUERIES,
    **query_outlook.QUERIES,
}
ORACLE = {
    **oracle_business.ORACLE, **oracle_profile.ORACLE, **oracle_features.ORACLE, **oracle_models.ORACLE, **oracle_learned.ORACLE,
    **oracle_outlook.ORACLE,
}

_unknown = set(ORACLE) - set(QUERIES)
if _unknown:
    raise RuntimeError(f"oracle without query: {sorted(_unknown)}")
