"""Tables stored in buckets of a join key, so that joins on it move no row of them."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame

from matchloom.session import shared_dir


def store_bucketed(df: DataFrame, keys: Sequence[str], buckets: int, database: str = "default", name: str | None = None) -> DataFrame:
    """Store ``df`` as a catalog table of ``buckets`` buckets of ``keys``, sorted by them, and read it.

    Two tables stored by the same keys in as many buckets are joined, and grouped by these keys, without a shuffle. The
    rows are gathered by bucket first, so a bucket is one file. A key with a large share of all rows makes a large bucket, which
    a join then reads in one task: for such tables leave the shuffle to Spark, which splits it.
    """
    table = f"{database}.{name or f'bucketed_{uuid.uuid4().hex[:12]}'}"
    (
        df.repartition(buckets, *keys)
        .write.mode("overwrite").option("path", shared_dir(df.sparkSession, "bucketed"))
        .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    )
    return df.sparkSession.read.table(table)
