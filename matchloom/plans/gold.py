"""Denormalised analytic tables.

The builders take stored silver tables. They reduce each fact to one row per
key before joining, so the joins see unique facts and no shuffle follows them;
``unique=True`` skips that step for inputs that already keep the contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.functions.documents import explode_positions
from matchloom.functions.metrics import per_minute, ratio_guarded, total_cs
from matchloom.operators.aggregates import one_name_per_id
from matchloom.operators.joins import enrich, lookup, restrict, valid_matches
from matchloom.operators.keys import latest_by_key, running_index
from matchloom.schemas import GOLD, NO_CHAMPION, SILVER, UNKNOWN_NAME



def _facts(df: DataFrame, table: str, unique: bool) -> DataFrame:
    return df if unique else latest_by_key(df, SILVER[table].key)


def team_stats(match_teams: DataFrame, matches: DataFrame, unique: bool = False) -> DataFrame:
    played = valid_matches(matches, "game_duration_seconds", "game_creation", "winning_team_id")
    teams = _facts(match_teams, "match_teams", unique)
    return GOLD["team_stats"].conform(enrich(teams, played, ["match_id"]))


def player_performance(
    participants: DataFrame, matches: DataFrame, accounts: DataFrame, unique: bool = False
) -> DataFrame:
    """Tracked players only: a participant without an account is left out."""
    played = valid_matches(matches, "game_duration_seconds")
    players = accounts.select("puuid", "game_name", "tag_line", "team")
    facts = enrich(
        enrich(_facts(participants, "match_participants", unique), played, ["match_id"]),
        players, ["puuid"],
    )
    cs = total_cs("total_minions_killed", "neutral_minions_killed")
    damage, seconds = "total_damage_dealt_to_champions", "game_duration_seconds"
    return GOLD["player_performance"].conform(
        facts.withColumns(
            {
                "total_cs": cs,
                "gold_per_minute": per_minute("gold_earned", seconds),
                "damage_per_minute": per_minute(damage, seconds),
                "cs_per_minute": per_minute(cs, seconds),
                "damage_per_gold": ratio_guarded(damage, "gold_earned"),
            }
        )
    )


def champion_map(participants: DataFrame) -> DataFrame:
    """One name per champion, from all known picks."""
    return one_name_per_id(participants, "champion_id", "champion_name")


def bans(match_teams: DataFrame) -> DataFrame:
    """One row per ban. The order is the place in the ban list, gaps kept."""
    placed = explode_positions(
        match_teams, "bans", "draft_order", "ban", "match_id", "team_id", "extraction_date"
    )
    return placed.select(
        "match_id", "team_id", F.col("ban").try_cast("int").alias("champion_id"),
        F.lit("ban").alias("type"), "draft_order", "extraction_date",
    ).filter(F.col("champion_id") != NO_CHAMPION)


def picks(participants: DataFrame) -> DataFrame:
    return participants.select(
        "match_id", "team_id", "champion_id", "champion_name", F.lit("pick").alias("type"),
        F.lit(None).cast("int").alias("draft_order"), "extraction_date",
    )


def draft(
    match_teams: DataFrame,
    participants: DataFrame,
    matches: DataFrame,
    champions: DataFrame | None = None,
) -> DataFrame:
    """Picks and bans of valid matches; a banned champion nobody ever picked is unknown.

    ``champions`` may be a stored or broadcastable ``champion_map``.
    """
    names = champion_map(participants) if champions is None else champions
    allowed = valid_matches(matches)
    banned = lookup(
        bans(restrict(match_teams, allowed, ["match_id"])), names, ["champion_id"],
        "champion_name", UNKNOWN_NAME,
    )
    picked = picks(restrict(participants, allowed, ["match_id"]))
    contract = GOLD["draft"]
    rows = contract.conform(banned).unionByName(contract.conform(picked))
    return latest_by_key(
        rows.filter(contract.key_is_set()), contract.key,
        ties=[F.asc_nulls_last("draft_order"), F.desc("champion_name")],
    )


def player_frames_indexed(
    frames: DataFrame, participants: DataFrame, matches: DataFrame, unique: bool = False
) -> DataFrame:
    """Frames numbered in time order; a frame without a known participant keeps NULL names."""
    people = latest_by_key(
        participants.select("match_id", "participant_id", "puuid", "champion_name", "extraction_date")
        .filter(F.col("participant_id").isNotNull()),
        ["match_id", "participant_id"],
    ).drop("extraction_date")
    facts = _facts(frames, "timeline_frames", unique)
    kept = restrict(facts, valid_matches(matches), ["match_id"])
    numbered = running_index(kept, ["match_id", "participant_id"], ["timestamp_ms"], "frame_index", ties=[])
    return GOLD["player_frames_indexed"].conform(
        enrich(numbered, people, ["match_id", "participant_id"], "left")
    )
