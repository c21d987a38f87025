"""What several corpus operators share: inputs, grouped batches, block pairs and connected components."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchloom.session import stage


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """A table of the test folder, only the named columns."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def small_batches(df: DataFrame) -> DataFrame:
    """Hand Python at most 2000 rows at a time: whole texts are long, and worker memory is bounded by a batch."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return df


def learn_in_task(sample: DataFrame, learn: Callable[[pa.Table], object]) -> object | None:
    """What ``learn`` makes of a bounded sample, in one task, so that the driver holds the result alone; None without rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            model = learn(pa.Table.from_batches(held))
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    got = sample.repartition(1).mapInArrow(run, "model binary").head()
    return pickle.loads(got.model) if got else None


def one_task_each(files: DataFrame, most: int = 10_000) -> DataFrame:
    """Deal a small table of files out so that as many tasks as there are files read them, ``most`` at most.

    The number is given, so adaptive execution does not merge the tasks.
    """
    return files.repartition(max(1, min(files.count(), most)))


def text_bytes(column: str = "text"):
    """The UTF-8 bytes of a text; NULL counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def complete_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Batches of rows sorted by ``keys``, cut so that no group is torn apart.

    Yields the rows and the number of each row's group within them. Memory holds one batch and one group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        starts = _starts(batch, keys)
        if held and _same(held[-1], batch, keys) and len(starts) == 1:
            held.append(batch)  # the group goes on
            continue
        cut = int(starts[-1])
        if held and cut == 0:
            yield _grouped(pa.Table.from_batches(held), keys)
            held = [batch]
            continue
        if held or cut:
            yield _grouped(pa.Table.from_batches([*held, batch.slice(0, cut)]), keys)
        held = [batch.slice(cut)]
    if held:
        yield _grouped(pa.Table.from_batches(held), keys)


def _starts(rows, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(rows.num_rows, dtype=bool)
    new[0] = True
    for key in keys:
        values = rows.column(key).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) \
            else rows.column(key).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _same(left: pa.RecordBatch, right: pa.RecordBatch, keys: Sequence[str]) -> bool:
    last = left.num_rows - 1
    return all(left.column(key)[last].as_py() == right.column(key)[0].as_py() for key in keys)


def _grouped(rows: pa.Table, keys: Sequence[str]) -> tuple[pa.Table, np.ndarray]:
    rows = rows.combine_chunks()
    group = np.zeros(rows.num_rows, dtype=np.int64)
    group[_starts(rows, keys)[1:]] = 1
    return rows, np.cumsum(group)


def blocked(rows: DataFrame, block: int = 512) -> DataFrame:
    """Deal the members of each bucket out to tasks that each see a bounded number of them.

    ``rows`` has ``slot``, ``bucket``, ``id`` and a payload. A bucket of more than ``block`` members is cut into
    chunks by a hash of the id, and each two chunks (``lo``, ``hi``) meet in one group; ``own`` is the chunk of
    the row. The result is dealt out and sorted by (slot, bucket, lo, hi).
    """
    large = (
        rows.groupBy("slot", "bucket").agg(F.count("*").alias("members")).filter(F.col("members") > block)
        .select("slot", "bucket", F.ceil(F.col("members") / block).cast("int").alias("chunks"))
    )
    own = F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1))).cast("int")
    keys = ["slot", "bucket", "lo", "hi"]
    return (
        rows.join(large, ["slot", "bucket"], "left")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)))
        .withColumn("lo", F.least("own", "other"))
        .withColumn("hi", F.greatest("own", "other"))
        .drop("chunks", "other")
        .repartition(*keys)
        .sortWithinPartitions(*keys)
    )


def close_rows(group: np.ndarray, lo: np.ndarray, hi: np.ndarray, own: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (i, j), i < j, of one group; of two chunks only pairs across. One array of pairs per distance."""
    size = len(group)
    for shift in range(1, size):
        left = np.flatnonzero(group[:-shift] == group[shift:])
        if not len(left):
            return
        right = left + shift
        across = (lo[left] == hi[left]) | (own[left] != own[right])
        yield left[across], right[across]


def smallest_linked(ids: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each row the smallest id among the rows it is connected with by the pairs (left, right)."""
    label = ids.copy()
    while True:
        before = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(label, left, low)
        np.minimum.at(label, right, low)
        if (before == label).all():
            return label


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``root`` (smallest id reachable) of every id in ``edges`` (a, b) but the roots themselves.

    Each round hooks every id to its smallest smaller neighbour, follows the hooks twice, and rewrites the edges
    by them. Rounds grow with the logarithm of the longest path. The edges and hooks of a round are written to the shared
    folder, so a lost executor repeats one round at most; the edges are counted while they are written, and that number is all
    that reaches the driver. An id is hooked in one round only, so the labels are the hooks of all rounds, followed in turn.
    """
    def tidy(df: DataFrame) -> tuple[DataFrame, int]:
        rows = (
            df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .filter("a <> b").distinct()
        )
        counted = Observation()
        return stage(rows.observe(counted, F.count(F.lit(1)).alias("n")), "edges"), counted.get["n"]

    (live, n), labels = tidy(edges), None
    while n:
        hook = live.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("root"))
        hook = stage(_follow(_follow(hook, hook), hook), "hooks")
        to = hook.select(F.col("id").alias("b"), F.col("root").alias("to"))  # every greater end is hooked
        moved = live.join(to, "b").select("a", F.col("to").alias("b"))
        to = hook.select(F.col("id").alias("a"), F.col("root").alias("to"))
        moved = moved.join(to, "a", "left").select(F.coalesce("to", "a").alias("a"), "b")
        labels = hook if labels is None else _follow(labels, hook).unionByName(hook)
        live, n = tidy(moved)
    if labels is None:
        return live.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return stage(labels, "labels")


def _follow(hook: DataFrame, further: DataFrame) -> DataFrame:
    to = further.select(F.col("id").alias("root"), F.col("root").alias("end"))
    return hook.join(to, "root", "left").select("id", F.coalesce("end", "root").alias("root"))
