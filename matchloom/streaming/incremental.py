"""Each landed file is processed exactly once; the checkpoint remembers which."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from matchloom.schemas import TableContract
from matchloom.sources.landing import load_bronze
from matchloom.sources.tables import write_upsert


def stream_documents(
    spark: SparkSession,
    base: str,
    entity: str,
    whole_file: bool = True,
    max_files: int | None = None,
    glob: str = "*.json",
) -> DataFrame:
    """The landing area as a stream of ``(raw_json, extraction_date)``."""
    reader = (
        spark.readStream.format("text").schema("value STRING, dt DATE")
        .option("wholetext", whole_file).option("pathGlobFilter", glob)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.load(f"{base.rstrip('/')}/{entity}")
    return rows.select(F.col("value").alias("raw_json"), F.col("dt").alias("extraction_date"))


def append_bronze(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append new documents to a bronze table, which batch loads may share, and stop when all are in.

    A micro-batch is named by its checkpoint and number, so a retry replaces what the first attempt wrote.
    """
    stream = f"stream-{zlib.crc32(checkpoint.rstrip('/').encode()):08x}"

    def append(batch: DataFrame, batch_id: int) -> None:
        load_bronze(batch, path, f"{stream}-{batch_id}")

    return (
        documents.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def upsert_stream(
    documents: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    contract: TableContract,
    root: str,
    checkpoint: str,
) -> StreamingQuery:
    """Upsert the rows ``build`` derives from each micro-batch.

    ``build`` leaves one row per key. The later extraction wins, so neither the
    order of the batches nor a retried batch changes the table.
    """
    def merge(batch: DataFrame, _batch_id: int) -> None:
        write_upsert(build(batch), contract, root, newest_wins=True)

    return (
        documents.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
