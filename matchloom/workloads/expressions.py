"""Scalar, JSON and row-generating functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.functions import documents as d
from matchloom.functions import metrics as m
from matchloom.workloads.inputs import Layers
from matchloom.workloads.lakehouse_sql import over_lakehouse
from matchloom.workloads.registry import query


@query("fn_from_json_struct", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events")
def from_json_struct(spark, sf):
    events = Layers(spark, sf).table("events").select("event_id", "props")
    return d.parse(events, "k INT", "props").select("event_id", "data.k")


@query(
    "fn_from_json_ddl",
    over_lakehouse("SELECT match_id, puuid, CAST(participant_id AS INT) AS participant_id FROM player_rows"),
)
def from_json_ddl(spark, sf):
    """SQL form: a JSON fragment exploded by a lateral view."""
    Layers(spark, sf).bronze("matches").createOrReplaceTempView("matchloom_bronze_matches")
    return spark.sql(
        """SELECT get_json_object(raw_json, '$.metadata.matchId') AS match_id, p.puuid,
                  p.participantId AS participant_id
           FROM matchloom_bronze_matches
           LATERAL VIEW explode(from_json(get_json_object(raw_json, '$.info.participants'),
               'ARRAY<STRUCT<participantId: INT, puuid: STRING>>')) AS p"""
    )


@query("tgf_lateral_explode", over_lakehouse("SELECT match_id, team_id, win FROM team_rows"))
def lateral_explode(spark, sf):
    """A lateral view of the teams of parsed documents; a document without teams gives no row."""
    Layers(spark, sf).parsed_for("match_teams").createOrReplaceTempView("matchloom_parsed_matches")
    return spark.sql(
        """SELECT match_id, t.teamId AS team_id, t.win FROM matchloom_parsed_matches
           LATERAL VIEW explode(info.teams) AS t"""
    )


@query("fn_get_json_object", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def get_json_object(spark, sf):
    return Layers(spark, sf).table("events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k")
    )


@query("tgf_explode", over_lakehouse("SELECT match_id, puuid, kills FROM player_rows"))
def explode(spark, sf):
    parsed = Layers(spark, sf).parsed_for("match_participants")
    return d.explode_children(parsed, "info.participants", "p", "match_id").select(
        "match_id", "p.puuid", "p.kills"
    )


POSITIONS = over_lakehouse(
    """SELECT match_id, team_id, unnest(bans) AS ban, CAST(generate_subscripts(bans, 1) AS INT) AS place
       FROM team_rows"""
)


@query("tgf_posexplode", POSITIONS)
def posexplode(spark, sf):
    """Bans with their place; NULL and empty lists give no rows."""
    teams = d.explode_children(Layers(spark, sf).parsed_for("match_teams"), "info.teams", "t", "match_id")
    bans = teams.select(
        "match_id", F.col("t.teamId").alias("team_id"),
        F.transform("t.bans", lambda b: b["championId"].cast("string")).alias("bans"),
    )
    return d.explode_positions(bans, "bans", "place", "ban", "match_id", "team_id")


@query(
    "tgf_lateral_posexplode",
    over_lakehouse("SELECT match_id, team_id, champion_id, draft_order FROM bans"),
)
def lateral_posexplode(spark, sf):
    Layers(spark, sf).silver("match_teams").createOrReplaceTempView("matchloom_silver_teams")
    return spark.sql(
        """SELECT match_id, team_id, CAST(ban AS INT) AS champion_id, pos + 1 AS draft_order
           FROM matchloom_silver_teams LATERAL VIEW posexplode(bans) AS pos, ban
           WHERE CAST(ban AS INT) <> -1"""
    )


@query(
    "tgf_map_explode",
    over_lakehouse("SELECT match_id, CAST(participant_id AS VARCHAR) AS participant, xp FROM frame_rows"),
)
def map_explode(spark, sf):
    frames = d.explode_children(Layers(spark, sf).parsed_for("timeline_frames"), "info.frames", "frame", "match_id")
    entries = d.explode_map(frames, "frame.participantFrames", "participant", "f", "match_id")
    return entries.select("match_id", "participant", "f.xp")


@query("fn_array_filter", over_lakehouse("SELECT match_id, winning_team_id FROM match_rows"))
def array_filter(spark, sf):
    """The first winning team; NULL where nobody won."""
    winner = d.first_where("info.teams", lambda t: t["win"])["teamId"]
    return Layers(spark, sf).parsed_for("matches").select("match_id", winner.alias("winning_team_id"))


@query(
    "fn_array_index",
    over_lakehouse("SELECT match_id, team_id, bans[1] AS first_ban, bans[4] AS fourth_ban FROM silver_match_teams"),
)
def array_index(spark, sf):
    """Elements by place; NULL beyond the end and for a NULL array."""
    return Layers(spark, sf).silver("match_teams").select(
        "match_id", "team_id", F.get("bans", 0).alias("first_ban"), F.get("bans", 3).alias("fourth_ban")
    )


@query(
    "fn_array_transform",
    over_lakehouse("SELECT match_id, team_id, array_to_string(bans, ',') AS bans FROM team_rows"),
)
def array_transform(spark, sf):
    teams = d.explode_children(Layers(spark, sf).parsed_for("match_teams"), "info.teams", "t", "match_id")
    return teams.select(
        "match_id", F.col("t.teamId").alias("team_id"),
        F.transform("t.bans", lambda b: b["championId"].cast("string")).alias("bans"),
    )


@query("fn_epoch_ms", over_lakehouse("SELECT match_id, game_creation, game_end_timestamp FROM match_rows"))
def epoch_ms(spark, sf):
    return Layers(spark, sf).parsed_for("matches").select(
        "match_id", d.from_epoch_ms("info.gameCreation").alias("game_creation"),
        d.from_epoch_ms("info.gameEndTimestamp").alias("game_end_timestamp"),
    )


@query(
    "fn_cast",
    """SELECT event_id, TRY_CAST(event_type AS INT) AS not_a_number, CAST(event_id AS VARCHAR) AS text,
              CAST(event_id AS DOUBLE) AS number, CAST(ts AS DATE) AS day
       FROM events""",
)
def casts(spark, sf):
    """A cast that fails gives NULL instead of stopping the job."""
    return Layers(spark, sf).table("events").select(
        "event_id", F.expr("try_cast(event_type AS INT)").alias("not_a_number"),
        F.col("event_id").cast("string").alias("text"), F.col("event_id").cast("double").alias("number"),
        F.col("ts").cast("date").alias("day"),
    )


@query("fn_date_literal", "SELECT event_id, DATE '2026-03-26' AS extraction_date FROM events")
def date_literal(spark, sf):
    return Layers(spark, sf).table("events").select(
        "event_id", F.lit("2026-03-26").cast("date").alias("extraction_date")
    )


@query(
    "fn_kda",
    """SELECT l_orderkey, l_linenumber, l_partkey,
              (l_quantity + l_partkey) / greatest(CASE WHEN l_linenumber > 1 THEN l_linenumber - 2 END, 1)
                  AS kda
       FROM lineitem""",
)
def kda(spark, sf):
    """Deaths of zero and unknown deaths both divide by one."""
    deaths = F.when(F.col("l_linenumber") > 1, F.col("l_linenumber") - 2)
    return Layers(spark, sf).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", m.kda("l_quantity", deaths, "l_partkey").alias("kda")
    )


@query(
    "fn_greatest",
    """SELECT event_id, greatest(CASE WHEN event_type <> 'click' THEN user_id END, event_id % 100, 40) AS largest FROM events""",
)
def greatest(spark, sf):
    """NULL is passed over, not passed on."""
    return Layers(spark, sf).table("events").select(
        "event_id",
        F.greatest(F.when(F.col("event_type") != "click", F.col("user_id")), F.col("event_id") % 100, F.lit(40)).alias("largest"),
    )


@query(
    "fn_total_cs",
    over_lakehouse(
        """SELECT match_id, puuid, total_minions_killed + neutral_minions_killed AS total_cs
           FROM silver_match_participants"""
    ),
)
def total_cs(spark, sf):
    return Layers(spark, sf).silver("match_participants").select(
        "match_id", "puuid", m.total_cs("total_minions_killed", "neutral_minions_killed").alias("total_cs")
    )


@query(
    "fn_rate_per_minute",
    """SELECT o_orderkey, o_totalprice / ((o_custkey + 1) / CAST(60 AS DOUBLE)) AS per_minute FROM orders""",
)
def rate_per_minute(spark, sf):
    orders = Layers(spark, sf).table("orders").withColumn("seconds", F.col("o_custkey") + 1)
    return orders.select("o_orderkey", m.per_minute("o_totalprice", "seconds").alias("per_minute"))


@query(
    "fn_ratio_guarded",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice / greatest(l_linenumber - 3, 1) AS ratio
       FROM lineitem""",
)
def ratio_guarded(spark, sf):
    return Layers(spark, sf).table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        m.ratio_guarded("l_extendedprice", F.col("l_linenumber") - 3).alias("ratio"),
    )


@query(
    "fn_round",
    over_lakehouse(
        """SELECT match_id, puuid, CAST(round(gold_earned * 100 / 1024, 2) AS DOUBLE) AS rounded
           FROM silver_match_participants"""
    ),
)
def rounded(spark, sf):
    """Presentation rounding, of values with a finite binary fraction."""
    exact = F.col("gold_earned").cast("double") * 100 / F.lit(1024)
    return Layers(spark, sf).silver("match_participants", once=True).select(
        "match_id", "puuid", F.round(exact, 2).alias("rounded")
    )


@query(
    "fn_coalesce_default",
    over_lakehouse("SELECT puuid, coalesce(team, 'UNKNOWN') AS team FROM silver_accounts"),
)
def coalesce_default(spark, sf):
    return Layers(spark, sf).silver("accounts").select(
        "puuid", F.coalesce("team", F.lit("UNKNOWN")).alias("team")
    )


@query(
    "fn_dict_default",
    """SELECT c_custkey, coalesce(CASE WHEN c_acctbal > 0 THEN upper(c_name) END, c_name) AS game_name
       FROM customer""",
)
def dict_default(spark, sf):
    answered = F.when(F.col("c_acctbal") > 0, F.upper("c_name"))
    return Layers(spark, sf).table("customer").select(
        "c_custkey", F.coalesce(answered, "c_name").alias("game_name")
    )


@query(
    "fn_minute_bucket",
    "SELECT event_id, CAST(epoch_ms(date_trunc('second', ts)) // 60000 AS INT) AS minute FROM events",
)
def minute_bucket(spark, sf):
    ms = F.unix_millis(F.date_trunc("second", "ts").cast("timestamp"))
    return Layers(spark, sf).table("events").select("event_id", d.minute_of(ms).alias("minute"))


@query("fn_concat_label", "SELECT c_custkey, concat_ws('/', c_mktsegment, c_name) AS label FROM customer")
def concat_label(spark, sf):
    return Layers(spark, sf).table("customer").select(
        "c_custkey", d.player_label("c_mktsegment", "c_name").alias("label")
    )
