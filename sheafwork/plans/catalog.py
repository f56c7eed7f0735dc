"""All queries of the library's own operators and the SQL for their rows."""

from sheafwork.plans import audits, converted, grids, laws, measures, ordering, payloads, quality, relations, texts, wiring, worlds  # noqa: F401  they register
from sheafwork.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
