"""Corpus operators for training data, apart from the rest of the library."""

from matchloom.llm.queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
