"""The rules each table has to keep, and the reports that check them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators.quality import (
    ConflictRule, DistinctPerGroupRule, ForeignKeyRule, FrameDensityRule, GroupRule, NotEmptyRule,
    RowRule, Rule, UniqueRule, check, combine, not_in, outside, pk_not_null,
)
from matchloom.schemas import (
    DRAFT_TYPES, GAME_CREATION_RANGE, GOLD, MIN_GAME_SECONDS, NO_CHAMPION, PARTICIPANT_IDS, SILVER,
    TEAM_IDS, TableContract,
)

# Rules that report on untracked players or pending data and never stop a run.
INFORMATIVE = ("dq_silver_fk_participant_account", "dq_ten_players", "dq_draft_count", "dq_ten_pids")

def _base(contract: TableContract) -> list[Rule]:
    return [
        NotEmptyRule(),
        pk_not_null(contract.key),
        UniqueRule("dq_pk_unique", contract.key),
    ]


def silver_rules(table: str, as_of: str = GAME_CREATION_RANGE[1]) -> list[Rule]:
    """Single-table rules; ``as_of`` is the latest plausible start of a game."""
    rules = _base(SILVER[table])
    if table == "matches":
        low = F.lit(GAME_CREATION_RANGE[0]).cast("timestamp")
        rules.append(RowRule("dq_ts_range", outside("game_creation", low, F.lit(as_of).cast("timestamp"))))
    if table in ("match_teams", "match_participants"):
        rules.append(RowRule("dq_team_domain", not_in("team_id", TEAM_IDS)))
    if table == "match_teams":
        rules.append(GroupRule("dq_silver_two_teams", ("match_id",), "n <> 2"))
    if table == "match_participants":
        rules += [
            RowRule("dq_kda_nonneg", F.col("kda") < 0),
            RowRule("dq_pid_populated", F.col("participant_id").isNull()),
            RowRule("dq_pid_range", outside("participant_id", *PARTICIPANT_IDS)),
            GroupRule("dq_silver_ten_participants", ("match_id",), "n <> 10"),
        ]
    if table in ("timeline_frames", "timeline_events"):
        rules.append(RowRule("dq_minute_nonneg", F.col("minute") < 0))
    return rules


def gold_rules(table: str) -> list[Rule]:
    rules = _base(GOLD[table])
    if table == "team_stats":
        rules += [
            RowRule("dq_team_domain", not_in("team_id", TEAM_IDS)),
            RowRule("dq_no_remake", F.col("game_duration_seconds") < MIN_GAME_SECONDS),
            GroupRule("dq_two_teams", ("match_id",), "n <> 2"),
        ]
    if table == "player_performance":
        rates = ("gold_per_minute", "damage_per_minute", "cs_per_minute", "damage_per_gold")
        negative = F.lit(False)
        for rate in rates:
            negative = negative | (F.col(rate) < 0)
        rules += [
            RowRule("dq_rates_nonneg", negative),
            RowRule("dq_gold_earned_pos", F.col("gold_earned") <= 0),
            RowRule("dq_no_remake", F.col("game_duration_seconds") < MIN_GAME_SECONDS),
            GroupRule("dq_player_count", ("match_id",), "n < 1 OR n > 10"),
            GroupRule("dq_ten_players", ("match_id",), "n <> 10"),
        ]
    if table == "draft":
        rules += [
            RowRule("dq_draft_type", not_in("type", DRAFT_TYPES)),
            RowRule("dq_no_sentinel", F.col("champion_id") == NO_CHAMPION),
            GroupRule("dq_draft_count", ("match_id",), "n < 10 OR n > 20"),
        ]
    if table == "player_frames_indexed":
        rules += [
            RowRule("dq_pid_range", outside("participant_id", *PARTICIPANT_IDS)),
            FrameDensityRule("dq_frame_gapless", ("match_id", "participant_id"), "frame_index"),
            DistinctPerGroupRule("dq_ten_pids", ("match_id",), "participant_id", "n <> 10"),
        ]
    return rules


def silver_references(silver: Mapping[str, DataFrame]) -> dict[str, list[Rule]]:
    """Cross-table rules by child table."""
    matches = silver["matches"]
    return {
        "match_teams": [ForeignKeyRule("dq_silver_fk_team_match", ("match_id",), matches)],
        "match_participants": [
            ForeignKeyRule("dq_silver_fk_participant_match", ("match_id",), matches),
            ForeignKeyRule("dq_silver_fk_participant_account", ("puuid",), silver["accounts"]),
        ],
        "timeline_frames": [ForeignKeyRule("dq_silver_fk_frame_match", ("match_id",), matches)],
        "timeline_events": [ForeignKeyRule("dq_silver_fk_event_match", ("match_id",), matches)],
    }


def gold_references(silver: Mapping[str, DataFrame]) -> dict[str, list[Rule]]:
    matches = silver["matches"]
    winners = matches.select("match_id", F.col("winning_team_id").alias("winner"))
    people = silver["match_participants"].filter(F.col("participant_id").isNotNull())
    is_winner = F.col("team_id") == F.col("winner")
    return {
        "team_stats": [
            ForeignKeyRule("dq_fk_team_match", ("match_id",), matches),
            ConflictRule("dq_win_coherent", ("match_id",), winners, is_winner & ~F.col("win")),
            ConflictRule("dq_win_coherent_reverse", ("match_id",), winners, ~is_winner & F.col("win")),
        ],
        "player_performance": [
            ForeignKeyRule("dq_fk_player_match", ("match_id",), matches),
            ForeignKeyRule("dq_fk_player_account", ("puuid",), silver["accounts"]),
        ],
        "player_frames_indexed": [
            ForeignKeyRule("dq_fk_frame_participant", ("match_id", "participant_id"), people)
        ],
    }


def validate_silver(silver: Mapping[str, DataFrame], as_of: str = GAME_CREATION_RANGE[1]) -> DataFrame:
    references = silver_references(silver)
    return combine(
        [
            check(f"silver_{t}", silver[t], silver_rules(t, as_of) + references.get(t, []))
            for t in SILVER
        ]
    )


def validate_gold(gold: Mapping[str, DataFrame], silver: Mapping[str, DataFrame]) -> DataFrame:
    references = gold_references(silver)
    return combine(
        [check(f"gold_{t}", gold[t], gold_rules(t) + references.get(t, [])) for t in GOLD]
    )
