"""Operators of a training-data pipeline. Nothing else in the library imports this part."""

from tidemark.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
