"""All registered queries."""

from __future__ import annotations

from tidemark.workload import features, ingest, panels, samples, streams  # noqa: F401  (they register)
from tidemark.workload.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
