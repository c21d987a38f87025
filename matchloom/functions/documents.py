"""Expressions and row generators over JSON documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.schemas import MS_PER_MINUTE


def parse(df: DataFrame, schema: T.DataType | str, raw: str = "raw_json", into: str = "data") -> DataFrame:
    """Replace the raw text by a typed column; a malformed document parses to NULLs."""
    others = [c for c in df.columns if c != raw]
    return df.select(F.from_json(raw, schema).alias(into), *others)


CORRUPT = "_corrupt"


def parse_or_reject(df: DataFrame, schema: T.StructType, key: str, raw: str = "raw_json", into: str = "data") -> DataFrame:
    """Like ``parse``, with ``reject``: NULL, or the raw text and the ``reason`` why the document has no key.

    One parse gives both. Documents with a key that are wrong in some field keep it, with NULL in that field.
    """
    others = [c for c in df.columns if c != raw]
    shape = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = df.select(F.from_json(raw, shape, {"columnNameOfCorruptRecord": CORRUPT}).alias(into), raw, *others)
    reason = (
        F.when(F.length(F.trim(F.coalesce(raw, F.lit("")))) == 0, "empty document")
        .when(F.col(f"{into}.{CORRUPT}").isNotNull(), "malformed JSON")
        .otherwise(f"no {key.split('.')[-1]}")
    )
    reject = F.when(F.col(f"{into}.{key}").isNull(), F.struct(F.col(raw), reason.alias("reason")))
    return parsed.select(into, reject.alias("reject"), *others)


def parse_fragment(raw: Column | str, path: str, ddl: str) -> Column:
    """Typed value of one JSON path, for readers that need just a corner of the document."""
    return F.from_json(F.get_json_object(raw, path), ddl)


def bad_documents(df: DataFrame, schema: T.StructType, key: str, raw: str = "raw_json") -> DataFrame:
    """Documents whose key is missing after parsing: the rows the builders leave out."""
    return df.filter(F.from_json(raw, schema)[key.split(".")[0]][key.split(".")[1]].isNull())


def explode_children(df: DataFrame, array: Column | str, into: str, *keep: Column | str) -> DataFrame:
    """One row per array element; a NULL or empty array gives none."""
    return df.select(*keep, F.explode(array).alias(into))


def explode_positions(df: DataFrame, array: str, position: str, into: str, *keep: Column | str) -> DataFrame:
    """One row per array element with its 1-based position."""
    rows = df.select(*keep, F.posexplode(array).alias("_pos", into))
    return rows.withColumn(position, F.col("_pos") + 1).drop("_pos")


def explode_map(df: DataFrame, entries: str, key: str, value: str, *keep: Column | str) -> DataFrame:
    """One row per map entry."""
    return df.select(*keep, F.explode(entries).alias(key, value))


def first_where(array: Column | str, predicate: Callable[[Column], Column]) -> Column:
    """First element that satisfies the predicate, NULL if none does."""
    return F.get(F.filter(array, predicate), 0)


def from_epoch_ms(ms: Column | str) -> Column:
    """Timestamp of epoch milliseconds; NULL outside the years 1 to 9999."""
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.when(ms.between(-62_135_596_800_000, 253_402_300_799_999), F.timestamp_millis(ms))


def minute_of(ms: Column | str) -> Column:
    ms = F.col(ms) if isinstance(ms, str) else ms
    return F.floor(ms / F.lit(MS_PER_MINUTE)).try_cast("int")


def player_label(team: str = "team", game_name: str = "game_name") -> Column:
    return F.concat_ws("/", team, game_name)
