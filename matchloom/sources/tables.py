"""Stored tables: contracts, creation, and upserts that rewrite the files they touch.

A table is a folder of Parquet files, by extraction day where its contract has one. A change finds the files that hold
its keys by a join with the hidden ``_metadata.file_path``, writes their other rows anew together with its own, and
deletes them when that is done. All other files stay as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchloom.operators.keys import latest_by_key
from matchloom.operators.quality import RowRule, observed, settle_counts
from matchloom.operators.upsert import replace_group
from matchloom.schemas import TableContract
from matchloom.session import delete_paths, path_exists, scratch, stage

DAY = "extraction_date"


def table_path(root: str, contract: TableContract) -> str:
    return f"{root.rstrip('/')}/{contract.layer}/{contract.name}"


def create_namespace(spark: SparkSession, database: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{where}")


def create_table(
    spark: SparkSession, database: str, contract: TableContract, location: str | None = None
) -> None:
    """Create the catalog table of a contract, and its database, unless they exist."""
    create_namespace(spark, database, location)
    comment = contract.comment.replace("'", "''")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {database}.{contract.name} ({contract.schema.toDDL()})"
        f" USING parquet COMMENT '{comment}'"
    )


def _files(spark: SparkSession, contract: TableContract, *paths: str, base: str | None = None) -> DataFrame:
    reader = spark.read.schema(contract.schema)
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.parquet(*paths)


def _stored(spark: SparkSession, root: str, contract: TableContract) -> DataFrame | None:
    path = table_path(root, contract)
    return _files(spark, contract, path) if path_exists(spark, path) else None


def read_table(spark: SparkSession, root: str, contract: TableContract) -> DataFrame:
    stored = _stored(spark, root, contract)
    if stored is None:
        return spark.createDataFrame([], contract.schema)
    return stored.select(*contract.columns)


def _add_files(rows: DataFrame, path: str, contract: TableContract) -> None:
    """Write rows as new files. Rebalancing gathers a day's rows and splits a day that is too large."""
    if DAY in contract.columns:
        rows.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(path)
    else:
        rows.hint("rebalance").write.mode("append").parquet(path)


def touched_files(stored: DataFrame, keys: DataFrame, on: Sequence[str]) -> list[str]:
    """The files of a stored table that hold any of the keys: a scan of the key columns, and one name per file found."""
    placed = stored.select(*on, F.col("_metadata.file_path").alias("_file"))
    found = placed.join(keys.select(*on).distinct(), list(on), "left_semi").select("_file").distinct()
    return _plain([r["_file"] for r in found.collect()])


def _plain(uris: Sequence[str]) -> list[str]:
    """Paths as readers take them; Spark names files as URIs, with blanks and the like escaped."""
    return [unquote(uri) for uri in uris]


def _swap(rows: DataFrame, old: Sequence[str], path: str, contract: TableContract) -> None:
    """New files first, then the old ones go: a driver that dies in between leaves rows twice, never none.

    Rows left twice are put right by the next change that touches them, as both files hold its keys.
    """
    _add_files(rows, path, contract)
    delete_paths(rows.sparkSession, old)


def write_upsert(
    source: DataFrame,
    contract: TableContract,
    root: str,
    group: tuple[str, ...] | None = None,
    newest_wins: bool = False,
    rules: Sequence[RowRule] = (),
    on_violation: str = "raise",
) -> dict[str, int]:
    """Upsert ``source``, one row per key, into the stored table.

    Files that hold none of its keys are neither rewritten nor, but for their key columns, read. A repeated run finds its own
    keys and rewrites them with the same values. With ``group`` whole groups (a prefix of the key) are replaced
    instead of single keys. With ``newest_wins`` a stored row with a later extraction date is kept.

    Violations of ``rules`` by the source are counted while it is staged, which takes no scan of its own, and returned. Under
    ``raise`` they stop the upsert before any file of the table changes.
    """
    spark, path = source.sparkSession, table_path(root, contract)
    if not rules and not path_exists(spark, path):  # nothing to count or to meet, so nothing to stage
        _add_files(contract.conform(source), path, contract)
        return {}
    with scratch(spark):
        rows, counts = observed(contract.conform(source), rules)
        rows = stage(rows, contract.name)
        violations = settle_counts(f"{contract.layer}_{contract.name}", counts, on_violation)
        stored = _stored(spark, root, contract)
        if stored is None:
            _add_files(rows, path, contract)
            return violations
        on = list(group or contract.key)
        touched = touched_files(stored, rows, on)
        if not touched:
            _add_files(rows, path, contract)
            return violations
        target = _files(spark, contract, *touched, base=path).select(*rows.columns)
        if group:
            merged = replace_group(target.dropDuplicates(list(contract.key)), rows, on)
        elif newest_wins:
            merged = latest_by_key(target.unionByName(rows), on)
        else:
            both = target.withColumn("_new", F.lit(False)).unionByName(rows.withColumn("_new", F.lit(True)))
            merged = latest_by_key(both, on, ["_new"], ties=[]).drop("_new")
        _swap(merged, touched, path, contract)
        return violations


def write_all(source: DataFrame, contract: TableContract, root: str) -> None:
    """Replace the whole stored table, which ``source`` must not be read from."""
    stored = _stored(source.sparkSession, root, contract)
    old = [] if stored is None else _plain(stored.inputFiles())
    _swap(contract.conform(source), old, table_path(root, contract), contract)


def write_replace(source: DataFrame, scope: DataFrame, contract: TableContract, root: str) -> None:
    """Replace the rows of all keys in ``scope`` by those of ``source``.

    ``scope`` has the first key column. Its keys lose their stored rows even where ``source`` has none for them;
    ``source`` has rows of these keys only. Files without such a key stay as they are.
    """
    spark, first, path = source.sparkSession, contract.key[0], table_path(root, contract)
    rows = contract.conform(source)
    stored = _stored(spark, root, contract)
    touched = [] if stored is None else touched_files(stored, scope, [first])
    if touched:
        target = _files(spark, contract, *touched, base=path).select(*rows.columns).dropDuplicates(list(contract.key))
        rows = target.join(scope.select(first), first, "left_anti").select(*rows.columns).unionByName(rows)
    _swap(rows, touched, path, contract)
