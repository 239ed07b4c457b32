"""All registered queries of the engine's operators and the SQL that checks them."""

from rasterloom.plans import file_queries, shape_queries  # noqa: F401  they register themselves
from rasterloom.plans.queries import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
