"""Every operator as a query over the test tables, beside the SQL that says the same."""

from lumenweb.plans.catalog import flagship, html, io, joins, labels, learning, more, rules, text, urls  # noqa: F401
from lumenweb.plans.catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
