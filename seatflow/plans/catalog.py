"""All registered queries of the listing operators, and their SQL for DuckDB."""

from __future__ import annotations

from seatflow.plans import checking, collecting, extracting, publishing, reporting, seats, storing  # noqa: F401
from seatflow.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
