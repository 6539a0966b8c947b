"""All registered queries. Importing the modules registers them."""

from prflow.queries import linking, loading, reading, storing  # noqa: F401
from prflow.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
