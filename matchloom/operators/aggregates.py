"""Aggregations. All reduce within the task before they shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(df: DataFrame, **rules: Column) -> DataFrame:
    """Several conditional counts in one pass."""
    return df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Total rows against distinct keys, via one partial count per key."""
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count("*").alias("distinct_keys")
    )


def groups_having(df: DataFrame, keys: Sequence[str], bad: Column) -> DataFrame:
    """Groups whose row count ``n`` satisfies ``bad``."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(bad)


def one_name_per_id(
    df: DataFrame, key: str, name: str, recency: str = "extraction_date"
) -> DataFrame:
    """The most recent name of each id, the greatest one on a tie."""
    pairs = df.filter(F.col(key).isNotNull()).groupBy(key, name).agg(F.max(recency).alias("_seen"))
    return pairs.groupBy(key).agg(F.max_by(name, F.struct("_seen", name)).alias(name))


def value_range(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def outcome_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count("*").alias("n"))
