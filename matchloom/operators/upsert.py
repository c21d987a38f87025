"""Merge semantics as plain DataFrame results.

``source`` must have one row per key (see ``latest_by_key``). Target rows whose
key is absent from the source are kept; nothing here deletes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators.keys import latest_by_key


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Replace the rows whose key is in the source, add the others."""
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def upsert_newest(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Upsert in which the later extraction wins, whichever side it is on.

    For inputs that may arrive out of order: the result does not depend on it.
    """
    return latest_by_key(target.unionByName(source.select(*target.columns)), keys)


def upsert_columns(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Upsert listed columns only: others keep their value, or are NULL on insert."""
    t, s = target.alias("t"), source.select(*keys, *columns).withColumn("_in_source", F.lit(True)).alias("s")
    on = [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys]
    merged = t.join(s, on, "full_outer")
    hit = F.col("s._in_source").isNotNull()

    def value(c: str) -> Column:
        if c in keys:
            return F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}"))
        if c in columns:
            return F.when(hit, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))
        return F.col(f"t.{c}")

    return merged.select(*[value(c).alias(c) for c in target.columns])


def _matched(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    renamed = source.select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_in_source")
    )
    return target.join(renamed, list(keys), "left")


def update_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Overwrite columns of existing rows; never insert."""
    hit = F.col("_in_source").isNotNull()
    new: Mapping[str, Column] = {
        c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns
    }
    return _matched(target, source, keys, columns).select(
        *[new[c].alias(c) if c in new else F.col(c) for c in target.columns]
    )


def backfill_nulls(
    target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Fill columns of existing rows only where they are NULL."""
    new = {c: F.coalesce(F.col(c), F.col(f"_new_{c}")) for c in columns}
    return _matched(target, source, keys, columns).select(
        *[new[c].alias(c) if c in new else F.col(c) for c in target.columns]
    )


def replace_group(target: DataFrame, source: DataFrame, group: Sequence[str]) -> DataFrame:
    """Replace whole groups, so rows a group no longer has disappear."""
    kept = target.join(source.select(*group).distinct(), list(group), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def add_column(df: DataFrame, name: str, data_type: T.DataType | str) -> DataFrame:
    """Add a NULL column unless it is there already."""
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(data_type))


def new_rows(source: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key has not landed yet."""
    return source.join(existing.select(*keys), list(keys), "left_anti")
