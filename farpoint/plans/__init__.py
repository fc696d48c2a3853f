"""Registered queries over the driver tables, and their SQL oracles."""

from farpoint.plans.oracle import ORACLE_SQL
from farpoint.plans.queries import QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
