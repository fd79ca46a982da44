"""The operators bound to concrete tables, each with the SQL that states its result."""

from delaylens.plans import daily, entities, models, rows, stored, summaries, variants  # noqa: F401
from delaylens.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
