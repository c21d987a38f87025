"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")

# Runtime settings every job relies on. All are ordinary SQL settings, so they
# also apply to a session somebody else created.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # A Bloom filter of a narrowed dimension drops facts before they are shuffled, also where the dimension is too large to
    # broadcast. Spark adds it only to scans that are large enough to repay it.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    # The shuffle files of a statement go when it ends. Otherwise a job of many statements holds them all until the driver
    # happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # The JVM never compiles methods above this size; those of wide documents are run step by step instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A compressed nested row is many times as large in a sort, so a task that explodes and sorts reads a small part.
    "spark.sql.files.maxPartitionBytes": "32MB",
}


def build_session(app: str = "matchloom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Without it, every column expression records its Python call site when a plan is built.
    quick = {"spark.python.sql.dataFrameDebugging.enabled": "false"}
    for key, value in {**quick, **SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_TEST_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path under the folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.conf.get("spark.app.id")
        if app not in _TEST_DIRS:
            _TEST_DIRS[app] = tempfile.mkdtemp(prefix="matchloom-")
        base = _TEST_DIRS[app]
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


# Joins of wide facts with a dimension too large to broadcast: they look it up in a hash table and need not sort the facts. Spark
# does so only where each part of the dimension is below this size.
HASH_JOINS = {"spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB"}
# Aggregates whose groups have about one row each: a first, small hash table before the large one finds next to nothing in it.
FINE_GROUPS = {"spark.sql.codegen.aggregate.map.twolevel.enabled": "false"}


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Runtime settings of what runs within the block."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def together(spark: SparkSession, *jobs: Callable[[], T]) -> list[T]:
    """Run jobs that need nothing of each other at the same time, so one takes the cores that the last tasks of another leave idle.

    Their shuffle files lie on disk together, so a table much larger than others is better written by itself. All have ended
    when the first error is raised. What they stage belongs to the caller's ``scratch``.
    """
    scopes = list(getattr(_SCRATCH, "open", []))

    def run(job: Callable[[], T]) -> T:
        _SCRATCH.open = list(scopes)
        return job()

    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(run), job) for job in jobs]
    return [job.result() for job in running]


# A staged table is written once and read a few times before it goes: dictionaries of its columns take its writer longer than they
# save, and zstd makes its files as small without them as snappy with them.
STAGED = {"compression": "zstd", "parquet.enable.dictionary": "false"}


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a layer boundary to the shared folder and read it back.

    Readers then share one computation, scan only the columns they use, and
    survive a lost executor without recomputing the lineage above.
    """
    path = shared_dir(df.sparkSession, f"stage-{name}")
    for staged in getattr(_SCRATCH, "open", [])[-1:]:
        staged.append(path)
    df.write.mode("overwrite").options(**STAGED).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH = threading.local()  # micro-batches run in threads of their own


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged within the block when it ends, so nothing lazy that reads it may leave the block."""
    if not hasattr(_SCRATCH, "open"):
        _SCRATCH.open = []
    _SCRATCH.open.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.open.pop():
            delete_path(spark, path)


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is; one that is absent stays so."""
    delete_paths(spark, [path])


def delete_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
