"""The operators bound to the given tables, each beside its SQL counterpart."""

from furrow.plans.bound import analysis, curation, gate, landing, learning, monitoring, warehouse  # noqa: F401
from furrow.plans.bound.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
