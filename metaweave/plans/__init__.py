"""Driver queries, their DuckDB oracles, and the table-building compositions."""

from metaweave.plans import curated, files  # noqa: F401  register their queries
from metaweave.plans.oracle import oracle_sql
from metaweave.plans.queries import queries

__all__ = ["oracle_sql", "queries"]
