"""The operators on relational test tables: documents derived from them, queries and their SQL."""

from matchloom.workloads import (  # noqa: F401
    contracts, expressions, relational, scans, streams, tables,
)
from matchloom.workloads.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
