"""All queries of the library and their SQL."""

from thicket.plans.oracles import oracle_sql
from thicket.plans.queries import queries

__all__ = ["oracle_sql", "queries"]
