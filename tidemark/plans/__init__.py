"""Ready-made queries over the test tables, each with the SQL it has to agree with."""

from tidemark.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
