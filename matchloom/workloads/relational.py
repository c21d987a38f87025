"""Filters, projections, joins, aggregates and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchloom.operators import aggregates as a
from matchloom.operators import joins as j
from matchloom.operators.keys import duplicate_keys, latest_by_key, running_index, top_n_by_key
from matchloom.operators.quality import not_in, outside
from matchloom.plans import gold as g
from matchloom.plans import silver as s
from matchloom.plans.ingest import new_ids_per_player
from matchloom.schemas import UNKNOWN_NAME
from matchloom.workloads.inputs import Layers
from matchloom.workloads.lakehouse_sql import over_lakehouse
from matchloom.workloads.registry import query

# --- projections and filters -------------------------------------------------


@query(
    "proj_nested",
    over_lakehouse(
        "SELECT match_id, team_id, baron_kills, rift_herald_kills, extraction_date FROM team_rows"
    ),
)
def nested(spark, sf):
    teams = Layers(spark, sf).parsed_for("match_teams").select(
        "match_id", F.explode("info.teams").alias("t"), "extraction_date"
    )
    return teams.select(
        "match_id", F.col("t.teamId").alias("team_id"),
        F.col("t.objectives.baron.kills").alias("baron_kills"),
        F.col("t.objectives.riftHerald.kills").alias("rift_herald_kills"), "extraction_date",
    )


@query(
    "proj_literal",
    over_lakehouse(
        """SELECT match_id, team_id, champion_id, 'pick' AS type, CAST(NULL AS INT) AS draft_order
           FROM silver_match_participants"""
    ),
)
def literal(spark, sf):
    return g.picks(Layers(spark, sf).silver("match_participants", once=True)).select(
        "match_id", "team_id", "champion_id", "type", "draft_order"
    )


@query("proj_star", "SELECT *, o_totalprice >= 50000 AS counts FROM orders")
def star(spark, sf):
    orders = Layers(spark, sf).table("orders")
    return orders.select("*", (F.col("o_totalprice") >= 50000).alias("counts"))


@query("proj_drop", "SELECT * EXCLUDE (ts, props) FROM events")
def drop(spark, sf):
    """A column that is absent is dropped without an error."""
    return Layers(spark, sf).table("events").drop("ts", "props", "absent")


@query("fetch_scalar", "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def scalar(spark, sf):
    """One value of one query, used in another."""
    orders = Layers(spark, sf).table("orders").select("o_orderkey", "o_orderdate")
    last = a.value_range(orders, "o_orderdate").select("max_value").scalar()
    return orders.filter(F.col("o_orderdate") == last)


@query("flt_threshold", "SELECT o_orderkey FROM orders WHERE floor(o_totalprice * 0.006) >= 300")
def threshold(spark, sf):
    orders = Layers(spark, sf).table("orders").select(
        F.col("o_orderkey").alias("match_id"), F.expr("floor(o_totalprice * 0.006)").alias("game_duration_seconds")
    )
    return j.valid_matches(orders).select(F.col("match_id").alias("o_orderkey"))


@query(
    "flt_not_null",
    over_lakehouse("SELECT match_id, puuid, deaths FROM silver_match_participants WHERE deaths IS NOT NULL"),
)
def not_null(spark, sf):
    people = Layers(spark, sf).silver("match_participants", once=True).select("match_id", "puuid", "deaths")
    return people.filter(F.col("deaths").isNotNull())


@query(
    "flt_sentinel",
    over_lakehouse("SELECT match_id, team_id, champion_id, draft_order FROM bans"),
)
def sentinel(spark, sf):
    return g.bans(Layers(spark, sf).silver("match_teams")).select(
        "match_id", "team_id", "champion_id", "draft_order"
    )


@query("flt_isin", "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('view', 'click')")
def isin(spark, sf):
    events = Layers(spark, sf).table("events").select("event_id", "event_type")
    return events.filter(not_in("event_type", ("view", "click")))


@query("flt_range", "SELECT p_partkey, p_size FROM part WHERE p_size < 5 OR p_size > 40")
def out_of_range(spark, sf):
    return Layers(spark, sf).table("part").select("p_partkey", "p_size").filter(outside("p_size", 5, 40))


@query(
    "flt_disjunction",
    over_lakehouse(
        """SELECT match_id, puuid FROM silver_match_participants
           WHERE deaths IS NULL OR gold_earned < 1 OR kills < 1"""
    ),
)
def disjunction(spark, sf):
    bad = F.col("deaths").isNull() | (F.col("gold_earned") < 1) | (F.col("kills") < 1)
    return Layers(spark, sf).silver("match_participants", once=True).filter(bad).select("match_id", "puuid")


# --- joins -------------------------------------------------------------------


@query(
    "join_teams_matches",
    over_lakehouse(
        """SELECT t.match_id, t.team_id, m.winning_team_id, m.game_creation
           FROM silver_match_teams t JOIN silver_matches m USING (match_id)"""
    ),
)
def teams_matches(spark, sf):
    """Both sides are stored by the join key, so neither is shuffled."""
    layers = Layers(spark, sf)
    matches = layers.bucketed("matches", ("match_id",)).select("match_id", "winning_team_id", "game_creation")
    return j.enrich(layers.bucketed("match_teams", ("match_id",)).select("match_id", "team_id"), matches, ["match_id"])


@query(
    "join_participants_matches",
    over_lakehouse(
        """SELECT p.match_id, p.puuid, m.game_duration_seconds
           FROM silver_match_participants p JOIN silver_matches m USING (match_id)
           WHERE m.game_duration_seconds >= 300"""
    ),
)
def participants_matches(spark, sf):
    layers = Layers(spark, sf)
    played = j.valid_matches(layers.silver("matches"), "game_duration_seconds")
    return j.enrich(layers.silver("match_participants").select("match_id", "puuid"), played, ["match_id"])


@query(
    "join_accounts",
    over_lakehouse(
        """SELECT p.match_id, p.puuid, a.game_name
           FROM silver_match_participants p JOIN silver_accounts a USING (puuid)"""
    ),
)
def with_accounts(spark, sf):
    layers = Layers(spark, sf)
    accounts = layers.silver("accounts").select("puuid", "game_name")
    return j.enrich(layers.silver("match_participants").select("match_id", "puuid"), accounts, ["puuid"])


@query(
    "join_three_way",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderdate, s_name
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       WHERE o_totalprice >= 50000""",
)
def three_way(spark, sf):
    layers = Layers(spark, sf)
    lines = layers.table("lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", F.col("l_suppkey").alias("s_suppkey")
    )
    orders = layers.table("orders").filter("o_totalprice >= 50000").select("o_orderkey", "o_orderdate")
    suppliers = layers.table("supplier").select("s_suppkey", "s_name")
    joined = j.enrich(j.enrich(lines, orders, ["o_orderkey"]), suppliers, ["s_suppkey"])
    return joined.withColumnsRenamed({"o_orderkey": "l_orderkey", "s_suppkey": "l_suppkey"})


@query(
    "join_valid_semi",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_totalprice >= 50000)""",
)
def valid_semi(spark, sf):
    layers = Layers(spark, sf)
    allowed = layers.table("orders").filter("o_totalprice >= 50000").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    lines = layers.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return j.restrict(lines, allowed, ["l_orderkey"])


@query(
    "join_left_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, coalesce(p_name, 'UNKNOWN') AS p_name
       FROM lineitem LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) p ON l_partkey = p_partkey""",
)
def left_lookup(spark, sf):
    layers = Layers(spark, sf)
    names = layers.table("part").filter("p_size <= 40").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    lines = layers.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return j.lookup(lines, names, ["l_partkey"], "p_name", UNKNOWN_NAME)


COMPOSITE = """SELECT f.match_id, f.participant_id, f.timestamp_ms, p.puuid
    FROM silver_timeline_frames f {how} JOIN frame_people p
    ON f.match_id = p.match_id AND f.participant_id = p.participant_id"""


def _frames_people(spark, sf, how: str):
    layers = Layers(spark, sf)
    people = latest_by_key(
        layers.silver("match_participants", once=True)
        .select("match_id", "participant_id", "puuid", "champion_name", "extraction_date"),
        ["match_id", "participant_id"],
    ).select("match_id", "participant_id", "puuid")
    frames = layers.silver("timeline_frames", once=True).select("match_id", "participant_id", "timestamp_ms")
    return j.enrich(frames, people, ["match_id", "participant_id"], how)


@query("join_left_composite", over_lakehouse(COMPOSITE.format(how="LEFT")))
def left_composite(spark, sf):
    return _frames_people(spark, sf, "left")


@query("join_inner_composite", over_lakehouse(COMPOSITE.format(how="INNER")))
def inner_composite(spark, sf):
    return _frames_people(spark, sf, "inner")


@query("join_left_anti", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def left_anti(spark, sf):
    layers = Layers(spark, sf)
    children = layers.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return j.orphans(layers.table("orders"), children, ["o_orderkey"])


@query(
    "join_left_anti_composite",
    over_lakehouse(
        """SELECT DISTINCT match_id, participant_id FROM silver_timeline_frames
           ANTI JOIN (SELECT match_id, participant_id FROM silver_match_participants
                      WHERE participant_id IS NOT NULL) p USING (match_id, participant_id)"""
    ),
)
def left_anti_composite(spark, sf):
    layers = Layers(spark, sf)
    people = layers.silver("match_participants").filter(F.col("participant_id").isNotNull())
    return j.orphans(layers.silver("timeline_frames"), people, ["match_id", "participant_id"])


@query(
    "join_residual",
    over_lakehouse(
        """SELECT t.match_id, t.team_id, m.winning_team_id FROM silver_match_teams t
           JOIN silver_matches m USING (match_id) WHERE t.team_id <> m.winning_team_id AND NOT t.win"""
    ),
)
def residual(spark, sf):
    layers = Layers(spark, sf)
    matches = layers.silver("matches").select("match_id", "winning_team_id")
    loser = (F.col("team_id") != F.col("winning_team_id")) & ~F.col("win")
    return j.conflicts(layers.silver("match_teams"), matches, ["match_id"], loser).select(
        "match_id", "team_id", "winning_team_id"
    )


# --- aggregates --------------------------------------------------------------


@query("agg_count", "SELECT count(*) AS n FROM lineitem")
def count(spark, sf):
    return Layers(spark, sf).table("lineitem").agg(F.count("*").alias("n"))


@query(
    "agg_count_if",
    """SELECT count(*) FILTER (l_quantity > 40) AS large, count(*) FILTER (l_discount = 0) AS full_price,
              count(*) FILTER (l_returnflag NOT IN ('A', 'N')) AS returned
       FROM lineitem""",
)
def count_if(spark, sf):
    return a.count_where(
        Layers(spark, sf).table("lineitem"), large=F.col("l_quantity") > 40,
        full_price=F.col("l_discount") == 0, returned=not_in("l_returnflag", ("A", "N")),
    )


@query("agg_min_max", "SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders")
def min_max(spark, sf):
    return a.value_range(Layers(spark, sf).table("orders"), "o_orderdate")


@query("agg_distinct", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct(spark, sf):
    return Layers(spark, sf).table("lineitem").select("l_orderkey", "l_linenumber").distinct()


@query("set_distinct", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_set(spark, sf):
    return Layers(spark, sf).table("events").dropDuplicates(["user_id", "event_type"]).select("user_id", "event_type")


@query(
    "agg_count_distinct_key",
    """SELECT count(*) AS total_rows, (SELECT count(*) FROM (
           SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS distinct_keys FROM lineitem""",
)
def count_distinct_key(spark, sf):
    return a.key_counts(Layers(spark, sf).table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "agg_group_having",
    "SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) <> 4",
)
def group_having(spark, sf):
    return a.groups_having(Layers(spark, sf).table("lineitem"), ["l_orderkey"], F.col("n") != 4)


@query(
    "agg_dup_keys",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events
       GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
def dup_keys(spark, sf):
    days = Layers(spark, sf).table("events").withColumn("day", F.col("ts").cast("date"))
    return duplicate_keys(days, ["user_id", "event_type", "day"])


@query(
    "agg_nested_count",
    """SELECT count(*) AS bad_groups FROM (
           SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) < 3 OR count(*) > 6)""",
)
def nested_count(spark, sf):
    bad = (F.col("n") < 3) | (F.col("n") > 6)
    groups = a.groups_having(Layers(spark, sf).table("lineitem"), ["l_orderkey"], bad)
    return groups.agg(F.count("*").alias("bad_groups"))


@query("agg_first_map", over_lakehouse("SELECT champion_id, champion_name FROM champion_map"))
def first_map(spark, sf):
    return g.champion_map(Layers(spark, sf).silver("match_participants"))


@query(
    "agg_new_per_player",
    """WITH f AS (SELECT l_orderkey, min(l_suppkey) AS s_suppkey FROM lineitem GROUP BY l_orderkey)
       SELECT s_name AS player, count(*) AS new_ids FROM f JOIN supplier USING (s_suppkey) GROUP BY s_name""",
)
def new_per_player(spark, sf):
    layers = Layers(spark, sf)
    suppliers = layers.table("supplier").select("s_suppkey", F.col("s_name").alias("player"))
    lists = layers.table("lineitem").select(
        F.col("l_orderkey").alias("match_id"), F.col("l_suppkey").alias("s_suppkey")
    )
    return new_ids_per_player(j.enrich(lists, suppliers, ["s_suppkey"]), "s_suppkey", "player")


@query("proj_narrow", "SELECT l_orderkey, l_suppkey, l_quantity FROM lineitem")
def narrow(spark, sf):
    return Layers(spark, sf).table("lineitem").select("l_orderkey", "l_suppkey", "l_quantity")


# --- windows -----------------------------------------------------------------

LATEST_LINE = """SELECT l_orderkey, {key}, l_shipdate, l_partkey, l_suppkey FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, {key}
        ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1"""


def _latest_line(spark, sf, key: str):
    lines = Layers(spark, sf).table("lineitem").select(
        "l_orderkey", key, "l_shipdate", "l_partkey", "l_suppkey"
    )
    return latest_by_key(lines, ["l_orderkey", key], ["l_shipdate"])


@query("win_latest_team", LATEST_LINE.format(key="l_linestatus"))
def latest_team(spark, sf):
    return _latest_line(spark, sf, "l_linestatus")


@query("win_latest_player", LATEST_LINE.format(key="l_linenumber"))
def latest_player(spark, sf):
    return _latest_line(spark, sf, "l_linenumber")


@query(
    "top1_per_key",
    """SELECT user_id, event_type, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value ASC, event_id DESC) = 1""",
)
def first_event(spark, sf):
    """The first row of each key in an order of its own, not the latest."""
    events = Layers(spark, sf).table("events").select("user_id", "event_type", "event_id", "value")
    return top_n_by_key(events, ["user_id", "event_type"], [F.asc("value"), F.desc("event_id")], 1)


@query(
    "win_latest_draft",
    over_lakehouse(
        """SELECT match_id, team_id, champion_id, type, draft_order, extraction_date FROM draft_rows
           QUALIFY row_number() OVER (PARTITION BY match_id, team_id, champion_id, type
               ORDER BY extraction_date DESC, draft_order ASC NULLS LAST) = 1"""
    ),
)
def latest_draft(spark, sf):
    layers = Layers(spark, sf)
    columns = ["match_id", "team_id", "champion_id", "type", "draft_order", "extraction_date"]
    rows = g.bans(layers.silver("match_teams")).select(*columns).unionByName(
        g.picks(layers.silver("match_participants")).select(*columns)
    )
    return latest_by_key(rows, columns[:4], ties=[F.asc_nulls_last("draft_order")])


@query(
    "win_latest_participant",
    over_lakehouse("SELECT match_id, participant_id, puuid, champion_name FROM frame_people"),
)
def latest_participant(spark, sf):
    people = Layers(spark, sf).silver("match_participants").select(
        "match_id", "participant_id", "puuid", "champion_name", "extraction_date"
    )
    return latest_by_key(people, ["match_id", "participant_id"]).drop("extraction_date")


@query(
    "win_latest_frame",
    """SELECT user_id, event_type, CAST(ts AS DATE) AS day, ts, event_id FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
           ORDER BY ts DESC, event_id DESC) = 1""",
)
def latest_frame(spark, sf):
    events = Layers(spark, sf).table("events").select(
        "user_id", "event_type", F.col("ts").cast("date").alias("day"), "ts", "event_id"
    )
    return latest_by_key(events, ["user_id", "event_type", "day"], ["ts"])


@query(
    "win_first_pid",
    over_lakehouse(
        """SELECT match_id, puuid, min(participant_id) AS participant_id FROM player_rows
           GROUP BY match_id, puuid"""
    ),
)
def first_pid(spark, sf):
    return s.participant_ids_first(Layers(spark, sf).parsed_for("match_participants"))


@query(
    "win_latest_pid_expr",
    over_lakehouse(
        """SELECT match_id, puuid, participant_id FROM player_rows
           QUALIFY row_number() OVER (PARTITION BY match_id, puuid
               ORDER BY extraction_date DESC, participant_id DESC) = 1"""
    ),
)
def latest_pid(spark, sf):
    return s.participant_ids_latest(Layers(spark, sf).bronze("matches"))


@query(
    "win_frame_index",
    """SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
           AS frame_index FROM events""",
)
def frame_index(spark, sf):
    events = Layers(spark, sf).table("events").select("user_id", "ts", "event_id")
    return running_index(events, ["user_id"], ["ts", "event_id"], "frame_index", ties=[])


@query(
    "sort_ban_order",
    over_lakehouse("SELECT match_id, team_id, champion_id, draft_order FROM bans ORDER BY match_id, team_id, draft_order"),
)
def ban_order(spark, sf):
    return g.bans(Layers(spark, sf).silver("match_teams")).select(
        "match_id", "team_id", "champion_id", "draft_order"
    ).orderBy("match_id", "team_id", "draft_order")


@query(
    "set_union_all",
    over_lakehouse(
        """SELECT match_id, team_id, champion_id, type, draft_order FROM bans
           UNION ALL
           SELECT match_id, team_id, champion_id, 'pick', CAST(NULL AS INT) FROM silver_match_participants"""
    ),
)
def union_all(spark, sf):
    layers = Layers(spark, sf)
    columns = ["match_id", "team_id", "champion_id", "type", "draft_order"]
    banned = g.bans(layers.silver("match_teams")).select(*columns)
    return banned.unionByName(g.picks(layers.silver("match_participants")).select(*columns))
