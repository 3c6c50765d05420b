"""Every query of the library and its SQL, by name."""

from __future__ import annotations

from retort.plans import answers, integrity, outputs, payloads, reactions, relational, scalar, screens  # noqa: F401  they register their queries
from retort.plans.base import ORACLE_SQL, QUERIES

FLAGSHIP = QUERIES["edges_to_summary"]

__all__ = ["FLAGSHIP", "ORACLE_SQL", "QUERIES"]
