"""The table builders and reports, layer by layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.documents import player_label
from matchloom.operators.upsert import add_column
from matchloom.plans import ingest, reports
from matchloom.plans.pipeline import amend_participant_ids
from matchloom.schemas import GOLD, SILVER
from matchloom.session import shared_dir
from matchloom.sources.landing import land_json, load_bronze, read_bronze, read_documents
from matchloom.workloads.documents import EVENT_FIELDS, POSITION
from matchloom.workloads.inputs import Layers
from matchloom.workloads.lakehouse_sql import over_lakehouse
from matchloom.workloads.registry import query


def _all_columns(contract, prefix: str) -> str:
    arrays = {f.name for f in contract.schema if f.dataType.typeName() == "array"}
    columns = ", ".join(
        f"array_to_string({c}, ',') AS {c}" if c in arrays else c for c in contract.columns
    )
    return over_lakehouse(f"SELECT {columns} FROM {prefix}_{contract.name}")


def _builders() -> None:
    for table, contract in SILVER.items():
        query(f"tbl_silver_{table}", _all_columns(contract, "silver"))(
            lambda spark, sf, t=table: Layers(spark, sf).build_silver(t)
        )
    for table, contract in GOLD.items():
        query(f"tbl_gold_{table}", _all_columns(contract, "gold"))(
            lambda spark, sf, t=table: Layers(spark, sf).build_gold(t, once=True)
        )


_builders()


LOADED_SQL = over_lakehouse(
    f"""SELECT match_id, at_ms, {POSITION['x']} AS x, at_ms + eid % 60000 AS later_ms,
           {EVENT_FIELDS['type']} AS type, extraction_date FROM timeline"""
)


def loaded(documents: DataFrame) -> DataFrame:
    """What tells timeline documents apart, read from their text."""
    def field(path: str):
        return F.get_json_object("raw_json", path)

    frame = "$.info.frames[0]"
    return documents.select(
        field("$.metadata.matchId").alias("match_id"), field(f"{frame}.timestamp").cast("bigint").alias("at_ms"),
        field(f"{frame}.events[0].position.x").cast("int").alias("x"), field(f"{frame}.events[1].timestamp").cast("bigint").alias("later_ms"),
        field(f"{frame}.events[0].type").alias("type"), "extraction_date",
    )


@query("tbl_bronze_load", LOADED_SQL)
def bronze_load(spark, sf):
    """Loading the same days twice leaves each document once."""
    path = shared_dir(spark, "bronze")
    documents = Layers(spark, sf).bronze("timelines")
    load_bronze(documents, path)
    load_bronze(documents, path)
    return loaded(read_bronze(spark, path))


@query(
    "tbl_silver_amend_pid",
    over_lakehouse(
        """SELECT p.match_id, p.puuid, x.participant_id
        FROM silver_match_participants p LEFT JOIN (
            SELECT match_id, puuid, participant_id FROM player_rows
            QUALIFY row_number() OVER (PARTITION BY match_id, puuid
                ORDER BY extraction_date DESC, participant_id DESC NULLS LAST) = 1) x
        ON p.match_id = x.match_id AND p.puuid = x.puuid"""
    ),
)
def amend(spark, sf):
    layers = Layers(spark, sf)
    before = layers.silver("match_participants").drop("participant_id")
    after = amend_participant_ids(before, layers.bronze("matches"))
    return add_column(after, "participant_id", "int").select("match_id", "puuid", "participant_id")


@query(
    "tbl_account_enrich",
    """SELECT s_name AS game_name, concat('T', s_nationkey) AS team,
           CASE WHEN s_acctbal > 0 THEN concat('S', s_suppkey) END AS puuid,
           CASE WHEN s_acctbal > 0 THEN CASE WHEN s_suppkey % 2 = 0 THEN upper(s_name) ELSE s_name END END
               AS game_name_api,
           CASE WHEN s_acctbal > 0 THEN 'resolved' ELSE 'failed' END AS outcome
       FROM supplier""",
)
def account_enrich(spark, sf):
    suppliers = Layers(spark, sf).table("supplier")
    roster = suppliers.select(
        F.concat(F.lit("T"), "s_nationkey").alias("team"), F.lit("support").alias("role"),
        F.col("s_name").alias("game_name"), F.lit("TAG").alias("tag_line"),
    )
    replies = suppliers.filter("s_acctbal > 0").select(
        F.col("s_name").alias("game_name"), F.lit("TAG").alias("tag_line"),
        F.concat(F.lit("S"), "s_suppkey").alias("puuid"),
        F.when(F.col("s_suppkey") % 2 == 0, F.upper("s_name")).alias("game_name_api"),
        F.lit(None).cast("string").alias("tag_line_api"),
    )
    found, failed = ingest.enrich_accounts(roster, replies)
    columns = ["game_name", "team", "puuid", "game_name_api", "outcome"]
    lost = failed.withColumns(
        {"puuid": F.lit(None).cast("string"), "game_name_api": F.lit(None).cast("string"),
         "outcome": F.lit("failed")}
    )
    return found.withColumn("outcome", F.lit("resolved")).select(*columns).unionByName(
        lost.select(*columns)
    )


def played(spark, sf):
    """(puuid, team, game_name, match_id, game_creation, queue_id) of every order's customer."""
    layers = Layers(spark, sf)
    return (
        layers.table("orders")
        .join(layers.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.concat(F.lit("C"), "c_custkey").alias("puuid"), F.col("c_mktsegment").alias("team"),
            F.col("c_name").alias("game_name"), F.col("c_custkey").alias("roster_order"),
            F.concat(F.lit("M"), "o_orderkey").alias("match_id"),
            F.col("o_orderdate").alias("game_creation"),
            F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 420).otherwise(440)
            .alias("queue_id"),
        )
    )


PLAYED_SQL = """
    WITH played AS (
        SELECT concat('C', c_custkey) AS puuid, concat_ws('/', c_mktsegment, c_name) AS player,
               c_custkey, concat('M', o_orderkey) AS match_id, o_orderdate AS game_creation
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
    latest AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY puuid ORDER BY game_creation DESC, match_id DESC)
            AS INT) AS place
        FROM played QUALIFY place <= 20)
"""


@query("latest_n", PLAYED_SQL + "SELECT puuid, place, match_id, game_creation FROM latest")
def latest_n(spark, sf):
    return ingest.latest_matches(played(spark, sf)).select("puuid", "place", "match_id", "game_creation")


@query(
    "tbl_match_id_collect",
    PLAYED_SQL
    + """SELECT 'player' AS part, player AS name, string_agg(match_id, ',' ORDER BY place) AS match_ids
         FROM latest GROUP BY puuid, player
         UNION ALL SELECT DISTINCT 'id', match_id, NULL FROM latest""",
)
def match_id_collect(spark, sf):
    """Both results of a collection: each player's ids, and the unique ids over all players."""
    latest = ingest.latest_matches(played(spark, sf))
    players = ingest.player_match_map(latest, player_label()).select(F.lit("player").alias("part"), F.col("player").alias("name"), "match_ids")
    ids = ingest.unique_match_ids(latest)
    return players.unionByName(
        ids.select(F.lit("id").alias("part"), F.col("match_id").alias("name"), F.lit(None).cast("array<string>").alias("match_ids"))
    )


@query(
    "tbl_match_ids_load",
    PLAYED_SQL
    + """SELECT 'id' AS part, match_id AS name, CAST(NULL AS VARCHAR) AS match_ids, DATE '2026-03-26' AS extraction_date
         FROM (SELECT DISTINCT match_id FROM latest)
         UNION ALL SELECT 'player', player, string_agg(match_id, ',' ORDER BY place), DATE '2026-03-26'
         FROM latest GROUP BY puuid, player""",
)
def match_ids_load(spark, sf):
    """Id list and player map landed under paths of their own, the list loaded into bronze, both read back."""
    base, bronze = shared_dir(spark, "landing"), shared_dir(spark, "bronze")
    latest, day = ingest.latest_matches(played(spark, sf)), F.lit("2026-03-26").alias("dt")
    land_json(latest.select("match_id", day).distinct(), base, "match_ids")
    land_json(ingest.player_match_map(latest, player_label()).select("*", day), base, "player_match_map")
    load_bronze(read_documents(spark, base, "match_ids", whole_file=False), bronze)
    ids = read_bronze(spark, bronze).select(
        F.lit("id").alias("part"), F.get_json_object("raw_json", "$.match_id").alias("name"),
        F.lit(None).cast("string").alias("match_ids"), "extraction_date",
    )
    players = read_documents(spark, base, "player_match_map", whole_file=False).select(
        F.from_json("raw_json", "player STRING, match_ids ARRAY<STRING>").alias("p"), "extraction_date"
    )
    return ids.unionByName(players.select(
        F.lit("player").alias("part"), F.col("p.player").alias("name"), F.array_join("p.match_ids", ",").alias("match_ids"),
        "extraction_date",
    ))


@query(
    "agg_player_map",
    PLAYED_SQL
    + "SELECT player, string_agg(match_id, ',' ORDER BY place) AS match_ids FROM latest GROUP BY puuid, player",
)
def player_map(spark, sf):
    return ingest.player_match_map(ingest.latest_matches(played(spark, sf)), player_label())


@query("agg_set_union", PLAYED_SQL + "SELECT DISTINCT match_id FROM latest")
def unique_ids(spark, sf):
    return ingest.unique_match_ids(ingest.latest_matches(played(spark, sf)))


@query("sort_ids", over_lakehouse("SELECT DISTINCT match_id FROM silver_timeline_frames ORDER BY match_id"))
def sorted_ids(spark, sf):
    return ingest.unique_match_ids(Layers(spark, sf).silver("timeline_frames"))


@query(
    "rpt_champion_pool",
    over_lakehouse(
        """SELECT puuid, champion_id, count(*) AS games, count(*) FILTER (win) AS wins,
               CAST(sum(CAST(kda AS DECIMAL(18,6))) AS DOUBLE) / count(kda) AS mean_kda
           FROM gold_player_performance GROUP BY puuid, champion_id"""
    ),
)
def champion_pool(spark, sf):
    return reports.champion_pool(Layers(spark, sf).gold("player_performance", once=True))


@query(
    "rpt_form_trend",
    over_lakehouse(
        """, games AS (
            SELECT p.match_id, p.puuid, p.kda, t.game_creation
            FROM gold_player_performance p JOIN silver_matches t USING (match_id))
        SELECT match_id, puuid, kda, game_creation,
            row_number() OVER (PARTITION BY puuid ORDER BY game_creation, match_id) AS game_number,
            CAST(sum(CAST(kda AS DECIMAL(18,6))) OVER w AS DOUBLE) / count(kda) OVER w AS form_kda
        FROM games WINDOW w AS (PARTITION BY puuid ORDER BY game_creation, match_id
                                ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"""
    ),
)
def form_trend(spark, sf):
    layers = Layers(spark, sf)
    return reports.form_trend(layers.gold("player_performance"), layers.silver("matches"))


@query(
    "rpt_draft_analysis",
    over_lakehouse(
        """SELECT champion_id, count(*) FILTER (type = 'pick') AS picks,
               count(*) FILTER (type = 'ban') AS bans,
               count(DISTINCT match_id) FILTER (type = 'pick')
                   / CAST((SELECT count(DISTINCT match_id) FROM gold_draft) AS DOUBLE) AS pick_rate,
               count(DISTINCT match_id) FILTER (type = 'ban')
                   / CAST((SELECT count(DISTINCT match_id) FROM gold_draft) AS DOUBLE) AS ban_rate
           FROM gold_draft GROUP BY champion_id"""
    ),
)
def draft_analysis(spark, sf):
    return reports.draft_analysis(Layers(spark, sf).gold("draft"))
