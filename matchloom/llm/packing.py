"""Packing token pieces into sequences by exact complements of lengths, then best fit."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from matchloom.llm.common import small_batches
from matchloom.llm.tokens import text_encoder
from matchloom.session import stage

CHUNK = 100_000  # pieces of one length numbered in one task, about


def pieces(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, with_ids: bool = False,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids`` (little-endian 32-bit bytes).

    A document is the ids of its whole text and ``end_id``. Only longer ones than ``capacity`` are cut, into pieces
    of ``capacity``; what does not divide is the first piece. NULL and empty texts are the end id alone.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, end = text_encoder(tokenizer, keep_space=True), np.array([end_id], "<u4").tobytes()
        for part in (b.slice(first, 256) for b in batches for first in range(0, b.num_rows, 256)):
            rows = []
            for doc, ids in zip(part.column(0).to_pylist(), cache.ids(part.column(1).to_pylist())):
                ids = memoryview(ids + end)
                size, start = len(ids) // 4, 0
                stop = size % capacity or capacity
                for piece in range(-(-size // capacity)):
                    cut_ids = ids[4 * start:4 * stop]
                    rows.append((doc, piece, start, stop - start, zlib.crc32(cut_ids), *([bytes(cut_ids)] * with_ids)))
                    start, stop = stop, stop + capacity
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)], schema.replace(",", "").split()[::2]
            )

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return small_batches(docs).select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    ).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how often each is packed, from the number of pieces of each length.

    From the longest length down, the gap it leaves is looked up among available single lengths, sums of two and
    sums of three, and a combination is consumed as often as its scarcest length allows. What finds no exact
    complement is packed by best fit, longest first. Work and result depend on ``capacity``, not on the number of pieces.
    """
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    done: list[tuple[tuple[int, ...], int]] = []

    def take(*lengths: int) -> None:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        times = min(int(left[x]) // n for x, n in need.items())
        for x, n in need.items():
            left[x] -= times * n
        done.append((lengths, times))

    if left[capacity]:
        take(capacity)
    for length in range(capacity - 1, 0, -1):
        while left[length]:
            left[length] -= 1  # the piece itself, so that its own length is offered only if there is another
            found = _fill(left, capacity - length)
            left[length] += 1
            if not found:
                break
            take(length, *found)
    return done + _best_fit(left, capacity)


def _fill(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three available lengths that add up to ``gap``; the longest first."""
    if left[gap]:
        return (gap,)
    two = _pair(left, gap, gap - 1)
    if two:
        return two
    for first in np.flatnonzero(left[:gap - 1])[::-1]:
        if 3 * first < gap:
            return None
        left[first] -= 1
        rest = _pair(left, gap - int(first), int(first))
        left[first] += 1
        if rest:
            return (int(first), *rest)
    return None


def _pair(left: np.ndarray, total: int, most: int) -> tuple[int, int] | None:
    """Two available lengths, the longer at most ``most``, that add up to ``total``."""
    low, high = (total + 1) // 2, min(most, total - 1)
    if high < low:
        return None
    longer = left[low:high + 1]
    shorter = left[total - high:total - low + 1][::-1]
    both = (longer > 0) & (shorter > 0)
    if total % 2 == 0:
        both[0] = longer[0] > 1
    hits = np.flatnonzero(both)
    return (low + int(hits[-1]), total - low - int(hits[-1])) if len(hits) else None


def _best_fit(left: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best fit by decreasing length; alike sequences are handled together."""
    by_gap: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in np.flatnonzero(left)[::-1].tolist():
        todo = int(left[length])
        while todo:
            gap = min((g for g in by_gap if g >= length), default=None)
            if gap is None:
                fits = capacity // length
                whole, rest = divmod(todo, fits)
                for n, times in ((fits, whole), (rest, 1)):
                    if n and times:
                        by_gap.setdefault(capacity - n * length, []).append(((length,) * n, times))
                break
            lengths, times = by_gap[gap].pop()
            if not by_gap[gap]:
                del by_gap[gap]
            used = min(times, todo)
            if times > used:
                by_gap.setdefault(gap, []).append((lengths, times - used))
            by_gap.setdefault(gap - length, []).append(((*lengths, length), used))
            todo -= used
    return [x for found in by_gap.values() for x in found]


def pack(parts: DataFrame, capacity: int = 2048) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``: as few sequences of at most ``capacity`` as the plan finds.

    ``parts`` has ``doc_id``, ``piece`` and ``length`` (1 to ``capacity``). Only the counts of the lengths reach the driver, at
    most ``capacity`` rows. The pieces of a length are numbered in hashed chunks of bounded size, so a length that
    many pieces share is many tasks; the number decides which place of the plan a piece takes. Rows repeated with
    one id are pieces of their own; an empty table gives an empty result. Sequences are gapless from offset 0.
    """
    spark = parts.sparkSession
    parts = stage(parts, "pieces")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError("lengths must be from 1 to the capacity")
    places, next_sequence, used = [], 0, {}
    for lengths, times in plan(counts, capacity):
        offset = 0
        for length in lengths:
            first = used.get(length, 0)
            places.append((length, first, first + times, next_sequence - first, offset))
            used[length] = first + times
            offset += length
        next_sequence += times
    planned = spark.createDataFrame(
        places, "length long, first long, until long, shift long, offset long"
    )
    chunks = max(1, -(-sum(counts.values()) // CHUNK))
    chunked = parts.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(chunks)).cast("int"))
    offsets = (
        chunked.groupBy("length", "chunk").agg(F.count("*").alias("n"))
        .select("length", "chunk", (F.sum("n").over(W.partitionBy("length").orderBy("chunk")) - F.col("n")).alias("before"))
    )
    order = W.partitionBy("length", "chunk").orderBy("doc_id", "piece")
    numbered = (
        chunked.withColumn("place", F.row_number().over(order) - 1)
        .join(offsets, ["length", "chunk"])
        .withColumn("place", F.col("before") + F.col("place"))
    )
    p = planned.alias("p")
    return (
        # The plan has a bounded number of rows: each of its steps uses up a length.
        numbered.alias("n").join(
            F.broadcast(p),
            (F.col("n.length") == F.col("p.length")) & (F.col("n.place") >= F.col("p.first")) & (F.col("n.place") < F.col("p.until")),
        )
        .select(*(F.col(f"n.{c}") for c in parts.columns), (F.col("n.place") + F.col("p.shift")).alias("sequence_id"), "p.offset")
    )


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """The packed pieces of all documents; see ``pieces`` and ``pack``."""
    return pack(pieces(docs, tokenizer, capacity, end_id), capacity)
