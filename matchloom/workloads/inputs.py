"""Stored layers the queries read, built once per application and data folder."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from matchloom.plans import gold as g
from matchloom.plans import silver as s
from matchloom.session import shared_dir
from matchloom.sources.bucketed import store_bucketed
from matchloom.sources.tables import create_namespace
from matchloom.workloads import documents as d

# Rows of a layer are many times as large in a sort as in a file, so a task reads one small row group at a time.
FILES = {"parquet.block.size": 16 << 20, "compression": "zstd"}

# The silver tables a gold table is built from.
SOURCES = {
    "team_stats": ("match_teams", "matches"),
    "player_performance": ("match_participants", "matches", "accounts"),
    "draft": ("match_teams", "match_participants", "matches"),
    "player_frames_indexed": ("timeline_frames", "match_participants", "matches"),
}

_STORED: dict[tuple[str, str, str], tuple[str, StructType]] = {}


class Layers:
    """Bronze documents, parsed documents, silver and gold tables of a data folder.

    Documents are written from the tables row by row whenever they are read: their text is many times the size of all
    else. Each further layer is written to the shared folder when first asked for, like those of a pipeline run, and read
    from there afterwards. One that a query reads ``once`` is not written for it, but read where another query wrote it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return d.table(self.spark, self.sf_dir, name)

    def _known(self, name: str) -> DataFrame | None:
        key = (self.spark.conf.get("spark.app.id"), self.sf_dir, name)
        if key in _STORED:
            path, schema = _STORED[key]
            try:
                return self.spark.read.schema(schema).parquet(path)
            except AnalysisException:
                del _STORED[key]
        return None

    def _stored(self, name: str, build: Callable[[], DataFrame], once: bool = False) -> DataFrame:
        key = (self.spark.conf.get("spark.app.id"), self.sf_dir, name)
        if (known := self._known(name)) is not None:
            return known
        if once:
            return build()
        path = shared_dir(self.spark, f"layer-{name}")
        rows = build()
        rows.write.options(**FILES).parquet(path)
        _STORED[key] = path, rows.schema
        return self.spark.read.schema(rows.schema).parquet(path)

    def bronze(self, entity: str) -> DataFrame:
        build = {
            "matches": d.match_documents, "timelines": d.timeline_documents,
            "accounts": d.account_documents,
        }[entity]
        return build(self.spark, self.sf_dir)

    def bucketed(self, table: str, keys: tuple[str, ...], buckets: int = 8) -> DataFrame:
        """A silver table once more, stored by the key that joins use."""
        name = f"{table}_{'_'.join(keys)}_{zlib.crc32(self.sf_dir.encode()):08x}"
        known = (self.spark.conf.get("spark.app.id"), self.sf_dir, f"bucketed-{name}")
        if known not in _STORED:
            create_namespace(self.spark, "matchloom_joins")
            stored = store_bucketed(self.silver(table), keys, buckets, "matchloom_joins", name)
            _STORED[known] = "", stored.schema
        return self.spark.read.table(f"matchloom_joins.{name}")

    def parsed(self, entity: str) -> DataFrame:
        build = {"matches": s.parsed_matches, "timelines": s.parsed_timelines}[entity]
        return self._stored(f"parsed-{entity}", lambda: build(self.bronze(entity)))

    def _entity(self, table: str) -> str:
        return "timelines" if table.startswith("timeline") else "matches"

    def parsed_for(self, table: str) -> DataFrame:
        """The parsed documents as far as a silver table reads them: stored if they are, else parsed on the way."""
        entity = self._entity(table)
        known = self._known(f"parsed-{entity}")
        return s.parsed_for(self.bronze(entity), table) if known is None else known

    def share_parse(self, *tables: str) -> None:
        """Store the parsed match documents for a query that reads these tables, if it builds all three from them.

        Writing every field costs more than parsing the fields of two tables apart.
        """
        silver = {name for table in tables for name in SOURCES.get(table, (table,))}
        if len({"matches", "match_teams", "match_participants"} & silver) == 3:
            self.parsed("matches")

    def build_silver(self, table: str) -> DataFrame:
        if table == "accounts":
            return s.accounts(self.bronze("accounts"))
        return getattr(s, table)(self.parsed_for(table))

    def silver(self, table: str, once: bool = False, apart: bool = False) -> DataFrame:
        """A silver table; ``apart``: stored without the parsed documents, for a query that builds few tables from them."""
        def build() -> DataFrame:
            if not (once or apart or table == "accounts"):
                self.parsed(self._entity(table))
            return self.build_silver(table)

        return self._stored(f"silver-{table}", build, once)

    def build_gold(self, table: str, once: bool = False) -> DataFrame:
        """A gold table from stored tables; ``once``: from stored matches, and of what else is read once nothing is stored."""
        self.share_parse(table)
        matches = self.silver("matches", apart=True)  # small, and rules read it again
        if table == "team_stats":
            return g.team_stats(self.silver("match_teams", once, apart=True), matches, unique=True)
        if table == "player_performance":
            people = self.silver("match_participants", once, apart=True)
            return g.player_performance(people, matches, self.silver("accounts"), unique=True)
        people = self.silver("match_participants", once and table != "draft", apart=True)  # the draft names champions by them too
        if table == "draft":
            return g.draft(self.silver("match_teams", once), people, matches)
        return g.player_frames_indexed(self.silver("timeline_frames", apart=True), people, matches, unique=True)

    def gold(self, table: str, once: bool = False) -> DataFrame:
        return self._stored(f"gold-{table}", lambda: self.build_gold(table, once=True), once)
