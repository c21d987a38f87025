"""Star-schema joins.

No join here carries an unconditional hint. Spark broadcasts a side when its
size, known from the files or measured at run time, is below the session's
limit; beyond it the join shuffles, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.schemas import MIN_GAME_SECONDS


def valid_matches(matches: DataFrame, *columns: str) -> DataFrame:
    """Matches long enough to count; an unknown duration does not."""
    kept = matches.filter(F.col("game_duration_seconds") >= MIN_GAME_SECONDS)
    return kept.select("match_id", *columns)


def enrich(fact: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Add the columns of a dimension that is unique on ``on``."""
    return fact.join(dimension, list(on), how)


def lookup(
    fact: DataFrame, names: DataFrame, on: Sequence[str], column: str, default: str
) -> DataFrame:
    """Left lookup of one column, with a default where there is no match."""
    found = fact.join(names, list(on), "left")
    return found.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def restrict(fact: DataFrame, allowed: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in ``allowed``; never multiplies rows."""
    return fact.join(allowed.select(*on), list(on), "left_semi")


def orphans(child: DataFrame, parent: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct child keys without a parent. NULL parent keys match nothing."""
    return child.select(*on).distinct().join(parent.select(*on), list(on), "left_anti")


def conflicts(left: DataFrame, right: DataFrame, on: Sequence[str], predicate: Column) -> DataFrame:
    """Joined rows that also satisfy a predicate across both sides."""
    return left.join(right, list(on)).filter(predicate)
