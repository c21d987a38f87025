"""Typed entity tables from raw documents.

The ``parsed_*`` functions parse a document once; the pipeline stores their
result, so that the table builders scan only the nested columns they need.
Every builder ends with one row per key, the latest extraction.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.functions.documents import (
    explode_children, explode_map, first_where, from_epoch_ms, minute_of, parse, parse_fragment, parse_or_reject,
)
from matchloom.functions.metrics import kda
from matchloom.operators.keys import latest_by_key, top_n_by_key
from matchloom.schemas import (
    ACCOUNTS_DOCUMENT, MATCH_DOCUMENT, SILVER, TIMELINE_DOCUMENT,
)

_OBJECTIVES = ("baron", "dragon", "tower", "inhibitor", "riftHerald")
_HEAD = (
    "gameCreation", "gameDuration", "gameEndTimestamp", "gameVersion", "gameMode", "gameType", "mapId", "queueId", "platformId",
)
# What each table reads of the ``info`` of its documents.
_READ = {
    "matches": (*_HEAD, "teams.teamId", "teams.win"),
    "match_teams": ("teams.teamId", "teams.win", *[f"teams.objectives.{o}.kills" for o in _OBJECTIVES], "teams.bans.championId"),
    "match_participants": ("participants",),
    "timeline_frames": ("frames.timestamp", "frames.participantFrames"),
    "timeline_events": ("frames.timestamp", "frames.events"),
}


def _snake(name: str) -> str:
    return "".join(f"_{c.lower()}" if c.isupper() else c for c in name)


def _fields(parent: str, *names: str) -> list[Column]:
    return [F.col(f"{parent}.{n}").alias(_snake(n)) for n in names]


def _finish(df: DataFrame, table: str) -> DataFrame:
    contract = SILVER[table]
    keyed = contract.conform(df).filter(contract.key_is_set())
    return latest_by_key(keyed, contract.key)


def parsed_matches(bronze: DataFrame) -> DataFrame:
    """(match_id, info, extraction_date, reject) of match documents.

    An unreadable document keeps a row without ``match_id``, which the builders
    leave out and ``rejects`` picks. Filtering here would make Spark parse each document twice, once
    for the filter and once for the columns.
    """
    return _parsed(bronze, MATCH_DOCUMENT)


def parsed_timelines(bronze: DataFrame) -> DataFrame:
    return _parsed(bronze, TIMELINE_DOCUMENT)


def _parsed(bronze: DataFrame, schema) -> DataFrame:
    documents = parse_or_reject(bronze, schema, "metadata.matchId")
    return documents.select(
        F.col("data.metadata.matchId").alias("match_id"), F.col("data.info").alias("info"),
        "extraction_date", "reject",
    )


def _only(kind: T.DataType, paths: Sequence[str]) -> T.DataType:
    """The part of a document's schema that holds these paths."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_only(kind.elementType, paths), kind.containsNull)
    below = {f.name: [p.partition(".")[2] for p in paths if p.split(".")[0] == f.name] for f in kind}
    return T.StructType([
        T.StructField(f.name, f.dataType if "" in below[f.name] else _only(f.dataType, below[f.name]), f.nullable)
        for f in kind if below[f.name]
    ])


def parsed_for(bronze: DataFrame, table: str) -> DataFrame:
    """(match_id, info, extraction_date) with what one table reads of its documents, parsed on the way.

    For a table that is built by itself: most of a parse is spent on the fields it keeps, and the rest on writing them. The row
    number, which Spark takes for nondeterministic, keeps a filter on parsed values above the parse, so each document is parsed
    once.
    """
    schema = TIMELINE_DOCUMENT if table.startswith("timeline") else MATCH_DOCUMENT
    wanted = _only(schema, ["metadata.matchId", *[f"info.{path}" for path in _READ[table]]])
    data = F.when(F.monotonically_increasing_id() >= 0, F.from_json("raw_json", wanted))
    return bronze.select(data.alias("data"), "extraction_date").select(
        F.col("data.metadata.matchId").alias("match_id"), F.col("data.info").alias("info"), "extraction_date"
    )


def rejects(parsed: DataFrame) -> DataFrame:
    """The documents of a parse that could not be read, as they came, each with the reason."""
    return parsed.filter(F.col("match_id").isNull()).select("reject.raw_json", "reject.reason", "extraction_date")


def accounts(bronze: DataFrame) -> DataFrame:
    """One row per player, from account files in either spelling."""
    records = explode_children(
        parse(bronze, ACCOUNTS_DOCUMENT), "data", "a", "extraction_date"
    )
    rows = records.select(
        F.col("a.puuid").alias("puuid"),
        F.coalesce("a.gameName", "a.game_name_api", "a.game_name").alias("game_name"),
        F.coalesce("a.tagLine", "a.tag_line_api", "a.tag_line").alias("tag_line"),
        F.col("a.team").alias("team"),
        F.col("a.role").alias("roster_role"),
        F.col("a.summonerLevel").try_cast("int").alias("summoner_level"),
        F.col("a.profileIconId").alias("profile_icon_id"),
        "extraction_date",
    )
    return _finish(rows, "accounts")


def matches(parsed: DataFrame) -> DataFrame:
    """One row per match; the winner is the first team marked as such, if any."""
    rows = parsed.select(
        "match_id",
        from_epoch_ms("info.gameCreation").alias("game_creation"),
        F.col("info.gameDuration").alias("game_duration_seconds"),
        from_epoch_ms("info.gameEndTimestamp").alias("game_end_timestamp"),
        *_fields("info", *_HEAD[3:]),
        first_where("info.teams", lambda t: t["win"])["teamId"].alias("winning_team_id"),
        "extraction_date",
    )
    return _finish(rows, "matches")


def match_teams(parsed: DataFrame) -> DataFrame:
    teams = explode_children(parsed, "info.teams", "team", "match_id", "extraction_date")
    rows = teams.select(
        "match_id",
        *_fields("team", "teamId", "win"),
        *[F.col(f"team.objectives.{o}.kills").alias(f"{_snake(o)}_kills") for o in _OBJECTIVES],
        F.transform("team.bans", lambda b: b["championId"].cast("string")).alias("bans"),
        "extraction_date",
    )
    return _finish(rows, "match_teams")


def match_participants(parsed: DataFrame) -> DataFrame:
    players = explode_children(parsed, "info.participants", "p", "match_id", "extraction_date")
    rows = players.select(
        "match_id",
        *_fields(
            "p", "puuid", "teamId", "championName", "championId", "individualPosition", "role",
            "kills", "deaths", "assists", "goldEarned", "totalMinionsKilled",
            "neutralMinionsKilled", "visionScore", "wardsPlaced", "wardsKilled",
            "totalDamageDealtToChampions", "totalDamageTaken", "totalHeal",
            "item0", "item1", "item2", "item3", "item4", "item5", "item6", "win", "participantId",
        ),
        F.col("p.summoner1Id").alias("summoner1_id"),
        F.col("p.summoner2Id").alias("summoner2_id"),
        kda("p.kills", "p.deaths", "p.assists").alias("kda"),
        "extraction_date",
    )
    return _finish(rows, "match_participants")


def participant_ids_first(parsed: DataFrame) -> DataFrame:
    """(match_id, puuid, participant_id) with the smallest id of each player."""
    players = explode_children(parsed, "info.participants", "p", "match_id")
    pairs = players.select("match_id", *_fields("p", "puuid", "participantId"))
    known = pairs.filter(F.col("puuid").isNotNull() & F.col("participant_id").isNotNull())
    return top_n_by_key(known, ["match_id", "puuid"], [F.asc("participant_id")], 1)


def participant_ids_latest(bronze: DataFrame) -> DataFrame:
    """(match_id, puuid, participant_id) of each player's latest document.

    Reads two JSON paths of the raw document instead of parsing all of it, each once: the filter is on what is exploded, as one
    on the columns before would read the paths again.
    """
    fragment = "ARRAY<STRUCT<participantId: INT, puuid: STRING>>"
    documents = bronze.select(
        F.get_json_object("raw_json", "$.metadata.matchId").alias("match_id"),
        parse_fragment("raw_json", "$.info.participants", fragment).alias("players"),
        "extraction_date",
    )
    of_match = F.transform("players", lambda p: F.struct("match_id", p["puuid"].alias("puuid"), p["participantId"].alias("participant_id")))
    pairs = explode_children(documents, of_match, "p", "extraction_date").select("p.*", "extraction_date")
    known = pairs.filter(F.col("match_id").isNotNull() & F.col("puuid").isNotNull())
    return latest_by_key(known, ["match_id", "puuid"]).drop("extraction_date")


def timeline_frames(parsed: DataFrame) -> DataFrame:
    """One row per player and frame: document → frames → entries keyed by participant."""
    frames = explode_children(parsed, "info.frames", "frame", "match_id", "extraction_date")
    entries = explode_map(
        frames, "frame.participantFrames", "participant", "f",
        "match_id", "extraction_date", F.col("frame.timestamp").alias("timestamp_ms"),
    )
    rows = entries.select(
        "match_id",
        F.coalesce(F.col("participant").try_cast("int"), "f.participantId").alias("participant_id"),
        "timestamp_ms",
        minute_of("timestamp_ms").alias("minute"),
        *_fields("f", "currentGold", "totalGold", "xp", "level", "minionsKilled",
                 "jungleMinionsKilled"),
        F.col("f.position.x").alias("position_x"),
        F.col("f.position.y").alias("position_y"),
        "extraction_date",
    )
    return _finish(rows, "timeline_frames")


def timeline_events(parsed: DataFrame) -> DataFrame:
    """One row per event; the index is the event's 0-based place in its frame."""
    frames = explode_children(parsed, "info.frames", "frame", "match_id", "extraction_date")
    events = frames.select(
        "match_id", "extraction_date", F.col("frame.timestamp").alias("frame_ms"),
        F.posexplode("frame.events").alias("event_index", "e"),
    )
    timed = events.withColumn("timestamp_ms", F.coalesce("e.timestamp", "frame_ms"))
    rows = timed.select(
        "match_id", "timestamp_ms", "event_index",
        minute_of("timestamp_ms").alias("minute"),
        *_fields("e", "type", "killerId", "victimId", "assistingParticipantIds", "itemId",
                 "wardType", "buildingType"),
        F.col("e.position.x").alias("position_x"),
        F.col("e.position.y").alias("position_y"),
        "extraction_date",
    )
    return _finish(rows, "timeline_events")
