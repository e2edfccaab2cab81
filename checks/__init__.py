"""Queries over the test tables with the SQL that checks them."""

from checks import history, reports, semantic, streams  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
