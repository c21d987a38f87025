"""Document schemas and table contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: limits and codes the results depend on --------------------
MIN_GAME_SECONDS = 300
NO_CHAMPION = -1
UNKNOWN_NAME = "UNKNOWN"
TEAM_IDS = (100, 200)
DRAFT_TYPES = ("pick", "ban")
PARTICIPANT_IDS = (1, 10)
MATCHES_PER_PLAYER = 20
RANKED_QUEUE = 420
GAME_CREATION_RANGE = ("2020-01-01", "2030-01-01")
MS_PER_MINUTE = 60_000
# -----------------------------------------------------------------------------


STRING, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
DOUBLE, BOOLEAN = T.DoubleType(), T.BooleanType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def _struct(*parts: tuple[str, T.DataType] | list[T.StructField]) -> T.StructType:
    fields = [T.StructField(*p) if isinstance(p, tuple) else p for p in parts]
    return T.StructType([f for part in fields for f in (part if isinstance(part, list) else [part])])


# --- Fixed values: fields of documents and tables, in their order there -------
DOCUMENT = _struct(("raw_json", STRING), ("extraction_date", DATE))
REJECTED_DOCUMENT = _struct(("raw_json", STRING), ("reason", STRING), ("extraction_date", DATE))

_OBJECTIVE = _struct(("first", BOOLEAN), ("kills", INT))
_BAN = _struct(("championId", INT), ("pickTurn", INT))
_TEAM = _struct(
    ("teamId", INT),
    ("win", BOOLEAN),
    ("objectives", _struct(("baron", _OBJECTIVE), ("dragon", _OBJECTIVE), ("tower", _OBJECTIVE), ("inhibitor", _OBJECTIVE), ("riftHerald", _OBJECTIVE))),
    ("bans", T.ArrayType(_BAN)),
)
_PLAYER = _struct(
    ("participantId", INT),
    ("puuid", STRING),
    ("teamId", INT),
    ("championName", STRING),
    ("championId", INT),
    ("individualPosition", STRING),
    ("role", STRING),
    ("kills", INT),
    ("deaths", INT),
    ("assists", INT),
    ("goldEarned", INT),
    ("totalMinionsKilled", INT),
    ("neutralMinionsKilled", INT),
    ("visionScore", INT),
    ("wardsPlaced", INT),
    ("wardsKilled", INT),
    ("totalDamageDealtToChampions", INT),
    ("totalDamageTaken", INT),
    ("totalHeal", INT),
    ("item0", INT),
    ("item1", INT),
    ("item2", INT),
    ("item3", INT),
    ("item4", INT),
    ("item5", INT),
    ("item6", INT),
    ("summoner1Id", INT),
    ("summoner2Id", INT),
    ("win", BOOLEAN),
)
MATCH_DOCUMENT = _struct(
    ("metadata", _struct(("dataVersion", STRING), ("matchId", STRING), ("participants", T.ArrayType(STRING)))),
    ("info", _struct(
            ("gameCreation", LONG),
            ("gameDuration", INT),
            ("gameEndTimestamp", LONG),
            ("gameVersion", STRING),
            ("gameMode", STRING),
            ("gameType", STRING),
            ("mapId", INT),
            ("queueId", INT),
            ("platformId", STRING),
            ("teams", T.ArrayType(_TEAM)),
            ("participants", T.ArrayType(_PLAYER)),
        )),
)

_POSITION = _struct(("x", INT), ("y", INT))
_PARTICIPANT_FRAME = _struct(
    ("participantId", INT),
    ("currentGold", INT),
    ("totalGold", INT),
    ("xp", INT),
    ("level", INT),
    ("minionsKilled", INT),
    ("jungleMinionsKilled", INT),
    ("position", _POSITION),
)
_EVENT = _struct(
    ("timestamp", LONG),
    ("type", STRING),
    ("killerId", INT),
    ("victimId", INT),
    ("assistingParticipantIds", T.ArrayType(INT)),
    ("position", _POSITION),
    ("itemId", INT),
    ("wardType", STRING),
    ("buildingType", STRING),
)
_FRAME = _struct(
    ("timestamp", LONG),
    ("participantFrames", T.MapType(STRING, _PARTICIPANT_FRAME)),
    ("events", T.ArrayType(_EVENT)),
)
TIMELINE_DOCUMENT = _struct(
    ("metadata", _struct(("matchId", STRING))),
    ("info", _struct(("frames", T.ArrayType(_FRAME)))),
)

# A landed accounts file is an array of records; both spellings of each field occur.
ACCOUNT_RECORD = _struct(
    ("puuid", STRING),
    ("team", STRING),
    ("role", STRING),
    ("game_name", STRING),
    ("tag_line", STRING),
    ("game_name_api", STRING),
    ("tag_line_api", STRING),
    ("extracted_at", STRING),
    ("gameName", STRING),
    ("tagLine", STRING),
    ("summonerLevel", LONG),
    ("profileIconId", INT),
)
ACCOUNTS_DOCUMENT = T.ArrayType(ACCOUNT_RECORD)

ROSTER = _struct(("team", STRING), ("role", STRING), ("game_name", STRING), ("tag_line", STRING))


@dataclass(frozen=True)
class TableContract:
    """Fixed columns and primary key of a persisted table."""

    layer: str
    name: str
    schema: T.StructType
    key: tuple[str, ...]
    comment: str = ""

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the contract's columns, in order and type; absent ones become NULL."""
        present = set(df.columns)
        return df.select(
            *[
                (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.schema
            ]
        )

    def key_is_set(self) -> Column:
        test = F.col(self.key[0]).isNotNull()
        for column in self.key[1:]:
            test = test & F.col(column).isNotNull()
        return test


_PARTICIPANT_STATS = _struct(
    ("kills", INT),
    ("deaths", INT),
    ("assists", INT),
    ("kda", DOUBLE),
    ("gold_earned", INT),
    ("total_minions_killed", INT),
    ("neutral_minions_killed", INT),
    ("vision_score", INT),
    ("wards_placed", INT),
    ("wards_killed", INT),
    ("total_damage_dealt_to_champions", INT),
    ("total_damage_taken", INT),
    ("total_heal", INT),
    ("item0", INT),
    ("item1", INT),
    ("item2", INT),
    ("item3", INT),
    ("item4", INT),
    ("item5", INT),
    ("item6", INT),
    ("summoner1_id", INT),
    ("summoner2_id", INT),
    ("win", BOOLEAN),
).fields
_TEAM_STATS = _struct(
    ("win", BOOLEAN),
    ("baron_kills", INT),
    ("dragon_kills", INT),
    ("tower_kills", INT),
    ("inhibitor_kills", INT),
    ("rift_herald_kills", INT),
).fields
_FRAME_STATS = _struct(
    ("timestamp_ms", LONG),
    ("minute", INT),
    ("current_gold", INT),
    ("total_gold", INT),
    ("xp", INT),
    ("level", INT),
    ("minions_killed", INT),
    ("jungle_minions_killed", INT),
    ("position_x", INT),
    ("position_y", INT),
).fields
_EXTRACTED = ("extraction_date", DATE)


def _contracts(layer: str, *tables: tuple[str, str, str, list]) -> dict[str, TableContract]:
    return {
        name: TableContract(layer, name, _struct(*parts, _EXTRACTED), tuple(key.split()), comment)
        for name, key, comment, parts in tables
    }


BRONZE = {
    name: TableContract("bronze", name, DOCUMENT, (), "raw documents")
    for name in ("accounts", "match_ids", "matches", "timelines")
}

SILVER = _contracts(
    "silver",
    ("accounts", "puuid", "one row per player", [
        ("puuid", STRING),
        ("game_name", STRING),
        ("tag_line", STRING),
        ("team", STRING),
        ("roster_role", STRING),
        ("summoner_level", INT),
        ("profile_icon_id", INT),
    ]),
    ("matches", "match_id", "one row per match", [
        ("match_id", STRING),
        ("game_creation", TIMESTAMP),
        ("game_duration_seconds", INT),
        ("game_end_timestamp", TIMESTAMP),
        ("game_version", STRING),
        ("game_mode", STRING),
        ("game_type", STRING),
        ("map_id", INT),
        ("queue_id", INT),
        ("platform_id", STRING),
        ("winning_team_id", INT),
    ]),
    ("match_teams", "match_id team_id", "one row per team and match", [
        ("match_id", STRING),
        ("team_id", INT),
        _TEAM_STATS,
        ("bans", T.ArrayType(STRING)),
    ]),
    ("match_participants", "match_id puuid", "one row per player and match", [
        ("match_id", STRING),
        ("puuid", STRING),
        ("participant_id", INT),
        ("team_id", INT),
        ("champion_name", STRING),
        ("champion_id", INT),
        ("individual_position", STRING),
        ("role", STRING),
        _PARTICIPANT_STATS,
    ]),
    ("timeline_frames", "match_id participant_id timestamp_ms", "one row per player, frame and match", [
        ("match_id", STRING),
        ("participant_id", INT),
        _FRAME_STATS,
    ]),
    ("timeline_events", "match_id timestamp_ms event_index", "one row per event and match", [
        ("match_id", STRING),
        ("timestamp_ms", LONG),
        ("event_index", INT),
        ("minute", INT),
        ("type", STRING),
        ("killer_id", INT),
        ("victim_id", INT),
        ("assisting_participant_ids", T.ArrayType(INT)),
        ("position_x", INT),
        ("position_y", INT),
        ("item_id", INT),
        ("ward_type", STRING),
        ("building_type", STRING),
    ]),
)

GOLD = _contracts(
    "gold",
    ("team_stats", "match_id team_id", "objectives and result per team and match", [
        ("match_id", STRING),
        ("team_id", INT),
        _TEAM_STATS,
        ("game_duration_seconds", INT),
        ("game_creation", TIMESTAMP),
        ("winning_team_id", INT),
    ]),
    ("player_performance", "match_id puuid", "performance and rates per tracked player and match", [
        ("match_id", STRING),
        ("puuid", STRING),
        ("game_name", STRING),
        ("tag_line", STRING),
        ("team", STRING),
        ("team_id", INT),
        ("champion_name", STRING),
        ("champion_id", INT),
        ("role", STRING),
        ("individual_position", STRING),
        _PARTICIPANT_STATS,
        ("total_cs", INT),
        ("gold_per_minute", DOUBLE),
        ("damage_per_minute", DOUBLE),
        ("cs_per_minute", DOUBLE),
        ("damage_per_gold", DOUBLE),
        ("game_duration_seconds", INT),
    ]),
    ("draft", "match_id team_id champion_id type", "picks and bans per team and match", [
        ("match_id", STRING),
        ("team_id", INT),
        ("champion_id", INT),
        ("champion_name", STRING),
        ("type", STRING),
        ("draft_order", INT),
    ]),
    ("player_frames_indexed", "match_id participant_id frame_index", "numbered timeline frames", [
        ("match_id", STRING),
        ("participant_id", INT),
        ("frame_index", INT),
        ("puuid", STRING),
        ("champion_name", STRING),
        _FRAME_STATS,
    ]),
)
