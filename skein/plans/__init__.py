"""Query catalogue: named plans over the test tables, each with its SQL oracle text."""

from skein.plans.registry import ORACLES, QUERIES, load_all

__all__ = ["ORACLES", "QUERIES", "load_all"]
