"""Structured Streaming over documents landed from the given tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from matchloom.plans import silver as s
from matchloom.schemas import SILVER
from matchloom.session import shared_dir
from matchloom.sources.landing import load_bronze, read_bronze
from matchloom.sources.tables import read_table
from matchloom.streaming.incremental import append_bronze, stream_documents, upsert_stream
from matchloom.workloads.inputs import Layers
from matchloom.workloads.lakehouse_sql import over_lakehouse
from matchloom.workloads.registry import query
from matchloom.workloads.tables import LOADED_SQL, loaded


def _landing(spark, sf, entity: str, part: Column | None = None) -> str:
    """The raw documents as text files by day, one document a line."""
    base = shared_dir(spark, "landing")
    documents = Layers(spark, sf).bronze(entity)
    documents = (documents if part is None else documents.filter(part)).select(
        F.col("raw_json").alias("value"), F.col("extraction_date").alias("dt")
    )
    documents.hint("rebalance", "dt").write.partitionBy("dt").text(f"{base}/{entity}")
    return base


@query("stream_incremental_bronze", LOADED_SQL)
def incremental_bronze(spark, sf):
    """A day's documents come by stream or by batch into one table; the stream's second run adds nothing."""
    by_batch = F.dayofmonth("extraction_date") % 2 == 0
    base = _landing(spark, sf, "timelines", ~by_batch)
    path, checkpoint = shared_dir(spark, "bronze"), shared_dir(spark, "checkpoint")
    for _ in range(2):
        documents = stream_documents(spark, base, "timelines", whole_file=False, max_files=20, glob="*.txt")
        append_bronze(documents, path, checkpoint).awaitTermination()
        load_bronze(Layers(spark, sf).bronze("timelines").filter(by_batch), path)
    return loaded(read_bronze(spark, path))


@query(
    "stream_foreach_upsert",
    over_lakehouse(
        """SELECT match_id, participant_id, timestamp_ms, total_gold, extraction_date
           FROM silver_timeline_frames"""
    ),
)
def foreach_upsert(spark, sf):
    """Frames upserted batch by batch; a batch may bring an older day after a newer one."""
    base = _landing(spark, sf, "timelines")
    contract, root = SILVER["timeline_frames"], shared_dir(spark, "lake")
    documents = stream_documents(spark, base, "timelines", whole_file=False, glob="*.txt", max_files=20)
    upsert_stream(
        documents, lambda batch: s.timeline_frames(s.parsed_timelines(batch)), contract, root,
        shared_dir(spark, "checkpoint"),
    ).awaitTermination()
    return read_table(spark, root, contract).select(
        "match_id", "participant_id", "timestamp_ms", "total_gold", "extraction_date"
    )
