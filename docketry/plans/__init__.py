"""Registered queries over the driver's tables, and the SQL that must give the same rows."""

from . import act_queries, inventory_queries, judgment_queries  # these register their queries
from .queries import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "act_queries", "inventory_queries", "judgment_queries"]
