"""The landing area ``<base>/<entity>/dt=YYYY-MM-DD/`` and the bronze tables loaded from it."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.schemas import DOCUMENT, REJECTED_DOCUMENT, ROSTER


def _partition(base: str, entity: str) -> str:
    return f"{base.rstrip('/')}/{entity}"


def read_documents(
    spark: SparkSession, base: str, entity: str, date: str | None = None, whole_file: bool = True, glob: str = "*.json"
) -> DataFrame:
    """Landed documents as ``(raw_json, extraction_date)``.

    ``whole_file`` reads a file as one document; otherwise each line is one,
    the layout to prefer at scale. A given ``date`` prunes the other days.
    """
    rows = (
        spark.read.format("text")
        .schema("value STRING, dt DATE")
        .option("wholetext", whole_file)
        .option("pathGlobFilter", glob)
        .load(_partition(base, entity))
    )
    if date is not None:
        rows = rows.filter(F.col("dt") == F.lit(date).cast("date"))
    return rows.select(F.col("value").alias("raw_json"), F.col("dt").alias("extraction_date"))


def documents_of_days(documents: DataFrame, days: DataFrame, day: str = "extraction_date") -> DataFrame:
    """Documents of the days that another table chooses. The chosen days prune the folders while the query runs."""
    return documents.join(days.select(day), day, "left_semi").select(*documents.columns)


def read_day(
    spark: SparkSession, base: str, entity: str, date: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Records of one landed day; a day that has not landed is empty."""
    try:
        return (
            spark.read.schema(schema).option("multiLine", multi_line)
            .json(f"{_partition(base, entity)}/dt={date}")
        )
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_roster(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """The tracked players: JSON records ``{team, role, game_name, tag_line}``."""
    return spark.read.schema(ROSTER).option("multiLine", multi_line).json(path)


def with_ingest_date(df: DataFrame, date: str) -> DataFrame:
    return df.withColumn("extraction_date", F.lit(date).cast("date"))


def with_lineage(df: DataFrame, date: str, source: str) -> DataFrame:
    """Attach where and when a document was extracted."""
    return df.withColumn(
        "_extraction_metadata",
        F.struct(
            F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("extracted_at"),
            F.lit(date).alias("execution_date"),
            F.lit(source).alias("source"),
        ),
    )


def land_json(df: DataFrame, base: str, entity: str, date_column: str = "dt") -> None:
    """Write documents as JSON lines, replacing only the days present in ``df``."""
    (
        df.hint("rebalance", date_column)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(date_column).json(_partition(base, entity))
    )


def load_bronze(documents: DataFrame, path: str, load: str = "day") -> None:
    """Load documents into a bronze table; repeating a load replaces what it brought for the same days.

    A day's documents lie apart by the ``load`` that brought them: batch loads are all ``day``, and each micro-batch of a
    stream has a name of its own, so a retried one writes the same files again and none touches another's. A document
    brought by both kinds occurs twice; silver keeps one row per key. Rebalancing gathers a day's documents
    into files of a sensible size, and spreads a large day over many tasks. Texts are written once and read seldom, so they
    are packed more closely than tables.
    """
    (
        documents.select(*DOCUMENT.fieldNames()).hint("rebalance", "extraction_date").withColumn("load", F.lit(load))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
        .partitionBy("extraction_date", "load").parquet(path)
    )


def load_rejects(rejects: DataFrame, path: str, date: str | None = None) -> None:
    """Replace the rejected documents of a day, or of all days: what has become readable leaves."""
    if date is None:
        whole = rejects.hint("rebalance", "extraction_date").write.mode("overwrite")
        whole.option("partitionOverwriteMode", "static").partitionBy("extraction_date").parquet(path)
    else:
        rejects.drop("extraction_date").hint("rebalance").write.mode("overwrite").parquet(f"{path}/extraction_date={date}")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """``raw_json``, ``reason`` and ``extraction_date`` of all documents that could not be read."""
    return spark.read.schema(REJECTED_DOCUMENT).parquet(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """All documents of a bronze table, whatever brought them."""
    layout = T.StructType([*DOCUMENT.fields, T.StructField("load", T.StringType())])
    return spark.read.schema(layout).parquet(path).select(*DOCUMENT.fieldNames())
