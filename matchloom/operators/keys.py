"""Operators on keys: latest row, top-n, running number, moving mean."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.session import stage


def _orderable(df: DataFrame, skip: set[str]) -> list[Column]:
    return [
        F.desc(f.name)
        for f in df.schema
        if f.name not in skip and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]


def top_n_by_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str | None = None, parts: int = 64
) -> DataFrame:
    """The first ``n`` rows of each key in a total order.

    The rank filter makes Spark drop all but ``n`` rows per key before the
    shuffle as well as after it, so a hot key sends at most ``n`` rows per task. Spark does so up to
    ``spark.sql.optimizer.windowGroupLimitThreshold`` rows. Above that the rows of a key are first cut to ``n`` in each of ``parts``
    parts, dealt by a hash of the row, so no task sees more than its part of a hot key, and then ``parts`` x ``n`` rows of it.
    """
    number = rank or "_rn"
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        hashed = [F.col(f.name) for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        dealt = df.withColumn("_salt", F.pmod(F.xxhash64(*hashed), F.lit(parts)))
        within = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = dealt.withColumn("_first", F.row_number().over(within)).filter(F.col("_first") <= n).drop("_salt", "_first")
    ranked = df.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(number) <= n)
    return kept if rank else kept.drop(number)


def latest_by_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column] = ("extraction_date",),
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """One row per key: the greatest in ``order``, descending, NULL last.

    Ties are broken by ``ties``; by default by all remaining columns, which
    makes the result independent of the input order.
    """
    leading = [F.desc(o) if isinstance(o, str) else o for o in order]
    if ties is None:
        ties = _orderable(df, set(keys) | {o for o in order if isinstance(o, str)})
    return top_n_by_key(df, keys, [*leading, *ties], 1)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def _count_runs(keys: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """For sorted rows, the place of each within the run of equal keys, from 1 on; the run may go on from the batch before."""
    before, count = None, 0
    for key in keys:  # a struct
        size, columns = len(key), key.flatten()
        if not size:
            yield pa.array([], pa.int64())
            continue
        new = np.zeros(size, dtype=bool)
        for column in columns:
            here, last = column.slice(1), column.slice(0, size - 1)
            differ = pc.or_(
                pc.fill_null(pc.not_equal(here, last), False), pc.xor(pc.is_null(here), pc.is_null(last))
            )
            new[1:] |= differ.to_numpy(zero_copy_only=False)
        new[0] = key[0].as_py() != before
        start = np.maximum.accumulate(np.where(new, np.arange(size), -1))
        place = np.arange(size) - start + 1
        place[start < 0] = count + 1 + np.arange(int((start < 0).sum()))
        before, count = key[size - 1].as_py(), int(place[-1])
        yield pa.array(place, pa.int64())


def numbered_ranges(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], ties: Sequence[Column] | None = None
) -> DataFrame:
    """``df`` dealt out by ranges of (key, order), with the range (``_part``) and each row's place in its key there (``_local``).

    Spark samples the rows for the borders of the ranges, so a range holds about as many rows as another whatever the
    keys are. The key columns alone go through Arrow to be numbered, in the task that sorted them. The table is written, so
    that borders and places do not change when a task is repeated.
    """
    leading = [F.asc(o) if isinstance(o, str) else o for o in order]
    if ties is None:
        ties = _orderable(df, set(keys) | {o for o in order if isinstance(o, str)})
    by = [*[F.asc(k) for k in keys], *leading, *ties]
    ranges = df.repartitionByRange(*by).sortWithinPartitions(*by)
    place = F.arrow_udf(_count_runs, T.LongType()).asNondeterministic()  # never moved below the sort
    return stage(ranges.withColumns({"_part": F.spark_partition_id(), "_local": place(F.struct(*keys))}), "ranges")


def running_index(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    name: str,
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, … without putting a key into one task.

    The rows are shuffled once, by ranges of (key, order); see :func:`numbered_ranges`. Only the key at the beginning of a range
    may have rows in ranges before it, so a range is corrected by one number, which comes from one row per range. Ties in
    ``order`` go by ``ties``, by default all remaining columns, so a key whose rows share one value of ``order`` is dealt
    out as well. Keys and order may be NULL, which sorts first. ``df`` is read twice, once for the sample: hand in a stored table.
    """
    numbered = numbered_ranges(df, keys, order, ties)
    key = F.struct(*keys)
    # One row per range: its first key, its last key, and how many rows of the last one it has.
    ends = numbered.groupBy("_part").agg(
        F.min(key).alias("first"), F.max(F.struct(key.alias("key"), F.col("_local").alias("rows"))).alias("last")
    )
    so_far = Window.partitionBy("last.key").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0)
    ends = ends.withColumn("upto", F.struct("last.key", F.sum("last.rows").over(so_far).alias("rows")))
    ends = ends.withColumn("before", F.lag("upto").over(Window.orderBy("_part")))
    offsets = ends.filter(F.col("before.key") == F.col("first")).select(
        F.col("_part").alias("_range"), *[F.col(f"first.{k}").alias(f"_first_{i}") for i, k in enumerate(keys)],
        F.col("before.rows").alias("_offset"),
    )
    same = F.col("_part") == F.col("_range")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_first_{i}"))
    return numbered.join(F.broadcast(offsets), same, "left").select(
        *df.columns, (F.col("_local") + F.coalesce("_offset", F.lit(0))).alias(name)
    )


def moving_mean(
    df: DataFrame,
    keys: Sequence[str],
    index: str,
    value: Column,
    size: int,
    name: str,
    chunk: int = 100_000,
) -> DataFrame:
    """Mean of ``value`` over each row and its ``size - 1`` predecessors by ``index``.

    ``index`` is the gapless number from :func:`running_index`. Each key is cut
    into chunks of ``chunk`` rows; the last ``size - 1`` rows of a chunk are
    copied into the next one, so chunks are independent and bounded.
    """
    if not 1 <= size <= chunk:
        raise ValueError("size must lie between 1 and chunk")
    position = F.col(index) - 1
    home = F.floor(position / chunk).cast("bigint")
    spill = F.floor((position + (size - 1)) / chunk).cast("bigint")
    homes = F.when(home == spill, F.array(home)).otherwise(F.array(home, spill))
    spread = df.withColumn("_home", home).withColumn("_chunk", F.explode(homes))
    frame = Window.partitionBy(*keys, "_chunk").orderBy(index).rowsBetween(-(size - 1), 0)
    exact = value.cast("decimal(18,6)")
    mean = F.sum(exact).over(frame).cast("double") / F.count(exact).over(frame)
    return (
        spread.withColumn(name, mean)
        .filter(F.col("_home") == F.col("_chunk"))
        .select(*df.columns, name)
    )
