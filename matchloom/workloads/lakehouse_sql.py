"""The lakehouse tables as SQL over the relational tables, for the checks."""

from __future__ import annotations

import re

from matchloom.schemas import SILVER
from matchloom.workloads.documents import (
    BANS_100, BANS_200, EPOCH_MS, EVENT_FIELDS, FRAME_FIELDS, FRAME_IDS, MATCH_COLUMNS, PLAYER_100,
    PLAYER_200, POSITION, TEAM_100, TEAM_200, TIMELINE_COLUMNS,
)


def _columns(formulas: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in formulas.items())


def _latest(source: str, table: str) -> str:
    contract = SILVER[table]
    ties = [c for c in contract.columns if c not in (*contract.key, "extraction_date")]
    order = ", ".join(f"{c} DESC NULLS LAST" for c in ["extraction_date", *ties])
    columns = ", ".join(contract.columns)
    return (
        f"SELECT {columns} FROM {source} QUALIFY row_number() OVER"
        f" (PARTITION BY {', '.join(contract.key)} ORDER BY {order}) = 1"
    )


def _team(team_id: int, win: str, stats: dict[str, str], bans: tuple[str, ...]) -> str:
    ban_list = ", ".join(f"CAST({b} AS VARCHAR)" for b in bans)
    return f"""
        SELECT match_id, {team_id} AS team_id, {win} AS win,
               CAST({stats['baron']} AS INT) AS baron_kills, CAST({stats['dragon']} AS INT) AS dragon_kills,
               CAST({stats['tower']} AS INT) AS tower_kills,
               CAST({stats['inhibitor']} AS INT) AS inhibitor_kills,
               CAST({stats['riftHerald']} AS INT) AS rift_herald_kills,
               CASE WHEN line = 7 THEN CAST([] AS VARCHAR[]) WHEN line <> 6 THEN [{ban_list}] END AS bans,
               extraction_date
        FROM landing"""


def _player(p: dict[str, str]) -> str:
    ints = {
        "team_id": "teamId", "champion_id": "championId", "kills": "kills", "deaths": "deaths",
        "assists": "assists", "gold_earned": "goldEarned", "total_minions_killed": "totalMinionsKilled",
        "neutral_minions_killed": "neutralMinionsKilled", "vision_score": "visionScore",
        "wards_placed": "wardsPlaced", "wards_killed": "wardsKilled",
        "total_damage_dealt_to_champions": "totalDamageDealtToChampions",
        "total_damage_taken": "totalDamageTaken", "total_heal": "totalHeal", "item0": "item0",
        "item1": "item1", "item2": "item2", "item3": "item3", "item4": "item4", "item5": "item5",
        "item6": "item6", "summoner1_id": "summoner1Id", "summoner2_id": "summoner2Id",
        "participant_id": "participantId",
    }
    numbers = ", ".join(f"CAST({p[raw]} AS INT) AS {name}" for name, raw in ints.items())
    return f"""
        SELECT match_id, {p['puuid']} AS puuid, {p['championName']} AS champion_name,
               {p['individualPosition']} AS individual_position, {p['role']} AS role, {numbers},
               {p['win']} AS win, extraction_date
        FROM landing"""


def _frame(participant: str) -> str:
    return f"""
        SELECT match_id, CAST({participant} AS INT) AS participant_id, at_ms AS timestamp_ms,
               CAST(at_ms // 60000 AS INT) AS minute,
               {FRAME_FIELDS['currentGold']} AS current_gold, {FRAME_FIELDS['totalGold']} AS total_gold,
               {FRAME_FIELDS['xp']} AS xp, {FRAME_FIELDS['level']} AS level,
               {FRAME_FIELDS['minionsKilled']} AS minions_killed,
               {FRAME_FIELDS['jungleMinionsKilled']} AS jungle_minions_killed,
               {POSITION['x']} AS position_x, {POSITION['y']} AS position_y, extraction_date
        FROM timeline"""


def _event(index: int, at: str) -> str:
    return f"""
        SELECT match_id, {at} AS timestamp_ms, {index} AS event_index,
               CAST(({at}) // 60000 AS INT) AS minute, {EVENT_FIELDS['type']} AS type,
               {EVENT_FIELDS['killerId']} AS killer_id, {EVENT_FIELDS['victimId']} AS victim_id,
               [1 + (eid + 1) % 10, 1 + (eid + 2) % 10] AS assisting_participant_ids,
               {POSITION['x']} AS position_x, {POSITION['y']} AS position_y,
               {EVENT_FIELDS['itemId']} AS item_id, {EVENT_FIELDS['wardType']} AS ward_type,
               {EVENT_FIELDS['buildingType']} AS building_type, extraction_date
        FROM timeline"""


CTES = {
    "landing": f"""SELECT {_columns(MATCH_COLUMNS)}, o_orderdate AS created
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "timeline": f"""SELECT {_columns(TIMELINE_COLUMNS)},
            CAST(ts AS DATE) + CAST(event_id % 3 AS INT) AS extraction_date,
            epoch_ms(date_trunc('hour', ts)) - {EPOCH_MS} AS at_ms
        FROM events""",
    "match_rows": """SELECT match_id, created AS game_creation, duration AS game_duration_seconds,
            created + to_seconds(duration) AS game_end_timestamp, version AS game_version,
            'CLASSIC' AS game_mode, 'MATCHED_GAME' AS game_type, 11 AS map_id,
            CAST(queue AS INT) AS queue_id, 'P1' AS platform_id,
            CASE WHEN win_100 THEN 100 WHEN win_200 THEN 200 END AS winning_team_id, extraction_date
        FROM landing""",
    "team_rows": _team(100, "win_100", TEAM_100, BANS_100) + " UNION ALL "
    + _team(200, "win_200", TEAM_200, BANS_200),
    "player_rows": "SELECT *, (CAST(kills AS DOUBLE) + CAST(assists AS DOUBLE))"
    " / CAST(greatest(deaths, 1) AS DOUBLE) AS kda FROM ("
    + _player(PLAYER_100) + " UNION ALL " + _player(PLAYER_200) + ")",
    "frame_rows": " UNION ALL ".join(_frame(p) for p in FRAME_IDS),
    "event_rows": _event(0, "at_ms") + " UNION ALL " + _event(1, "at_ms + eid % 60000"),
    "silver_accounts": """SELECT concat('S', s_suppkey) AS puuid, upper(s_name) AS game_name,
            'TAG' AS tag_line, concat('T', s_nationkey) AS team, 'support' AS roster_role,
            CAST(NULL AS INT) AS summoner_level, CAST(NULL AS INT) AS profile_icon_id,
            DATE '2001-01-01' AS extraction_date
        FROM supplier
        UNION ALL
        SELECT concat('C', c_custkey), c_name, 'CUS', NULL, NULL, CAST(c_custkey % 500 AS INT),
            CAST(c_custkey % 30 AS INT), DATE '2001-01-01'
        FROM customer""",
    "silver_matches": _latest("match_rows", "matches"),
    "silver_match_teams": _latest("team_rows", "match_teams"),
    "silver_match_participants": _latest("player_rows", "match_participants"),
    "silver_timeline_frames": _latest("frame_rows", "timeline_frames"),
    "silver_timeline_events": _latest("event_rows", "timeline_events"),
    "gold_team_stats": """SELECT t.* EXCLUDE (bans), m.game_duration_seconds, m.game_creation,
            m.winning_team_id
        FROM silver_match_teams t JOIN silver_matches m USING (match_id)
        WHERE m.game_duration_seconds >= 300""",
    "gold_player_performance": """SELECT p.* EXCLUDE (participant_id), a.game_name, a.tag_line, a.team,
            m.game_duration_seconds,
            p.total_minions_killed + p.neutral_minions_killed AS total_cs,
            p.gold_earned / (m.game_duration_seconds / CAST(60 AS DOUBLE)) AS gold_per_minute,
            p.total_damage_dealt_to_champions / (m.game_duration_seconds / CAST(60 AS DOUBLE))
                AS damage_per_minute,
            (p.total_minions_killed + p.neutral_minions_killed)
                / (m.game_duration_seconds / CAST(60 AS DOUBLE)) AS cs_per_minute,
            p.total_damage_dealt_to_champions / CAST(greatest(p.gold_earned, 1) AS DOUBLE)
                AS damage_per_gold
        FROM silver_match_participants p
        JOIN silver_matches m ON p.match_id = m.match_id
        JOIN silver_accounts a ON p.puuid = a.puuid
        WHERE m.game_duration_seconds >= 300""",
    "champion_map": """SELECT champion_id, champion_name FROM silver_match_participants
        QUALIFY row_number() OVER (PARTITION BY champion_id
            ORDER BY extraction_date DESC, champion_name DESC) = 1""",
    "valid": "SELECT match_id FROM silver_matches WHERE game_duration_seconds >= 300",
    "bans": """SELECT match_id, team_id, CAST(ban AS INT) AS champion_id, 'ban' AS type,
            CAST(pos AS INT) AS draft_order, extraction_date
        FROM (SELECT match_id, team_id, unnest(bans) AS ban, generate_subscripts(bans, 1) AS pos,
                     extraction_date FROM silver_match_teams)
        WHERE CAST(ban AS INT) <> -1""",
    "draft_rows": """SELECT b.match_id, b.team_id, b.champion_id,
            coalesce(c.champion_name, 'UNKNOWN') AS champion_name, b.type, b.draft_order,
            b.extraction_date
        FROM bans b LEFT JOIN champion_map c USING (champion_id)
        UNION ALL
        SELECT match_id, team_id, champion_id, champion_name, 'pick', CAST(NULL AS INT), extraction_date
        FROM silver_match_participants""",
    "gold_draft": """SELECT d.* FROM draft_rows d SEMI JOIN valid USING (match_id)
        QUALIFY row_number() OVER (PARTITION BY match_id, team_id, champion_id, type
            ORDER BY extraction_date DESC, draft_order ASC NULLS LAST, champion_name DESC) = 1""",
    "frame_people": """SELECT match_id, participant_id, puuid, champion_name
        FROM silver_match_participants
        QUALIFY row_number() OVER (PARTITION BY match_id, participant_id
            ORDER BY extraction_date DESC, puuid DESC, champion_name DESC) = 1""",
    "gold_player_frames_indexed": """SELECT f.*, p.puuid, p.champion_name,
            CAST(row_number() OVER (PARTITION BY f.match_id, f.participant_id ORDER BY f.timestamp_ms)
                AS INT) AS frame_index
        FROM silver_timeline_frames f SEMI JOIN valid USING (match_id)
        LEFT JOIN frame_people p ON f.match_id = p.match_id AND f.participant_id = p.participant_id""",
}

def _named(sql: str) -> set[str]:
    return set(re.findall(r"\w+", sql)) & CTES.keys()


def over_lakehouse(sql: str) -> str:
    """SQL that may name any of the tables above, with those it reaches."""
    reached, found = set(), _named(sql)
    while found:
        reached |= found
        found = set().union(*(_named(CTES[name]) for name in found)) - reached
    # In the order above, in which each only names those before it.
    tables = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items() if name in reached)
    return f"WITH {tables}\n{sql}" if tables else sql
