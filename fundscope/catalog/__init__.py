"""Registered queries of the library, each with the SQL that it must equal, keyed by name."""

from __future__ import annotations

from . import algorithms, core, derived, extras, functions, jobs, joins, merges, orders, reports, rules
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "algorithms", "core", "derived", "extras", "functions", "jobs", "joins", "merges", "orders", "reports", "rules"]
