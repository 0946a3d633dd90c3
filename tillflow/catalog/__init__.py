"""Registered queries with their SQL twins, one module per section of the operator inventory."""

from . import aggregates, composites, hubs, jobs, joins, mechanisms, rows, scalars, windows  # noqa: F401  (registration)
from .registry import ORACLES, PLAIN, QUERIES

__all__ = ["ORACLES", "PLAIN", "QUERIES"]
