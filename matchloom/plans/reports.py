"""Dashboard queries over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchloom.operators.keys import moving_mean, running_index
from matchloom.session import stage

FORM_GAMES = 5


def _mean(column: str):
    # A decimal sum does not depend on the order of its terms, a double sum does.
    exact = F.col(column).cast("decimal(18,6)")
    return F.sum(exact).cast("double") / F.count(exact)


def champion_pool(performance: DataFrame) -> DataFrame:
    """Games, wins and mean KDA per player and champion."""
    return performance.groupBy("puuid", "champion_id").agg(
        F.count("*").alias("games"), F.count_if(F.col("win")).alias("wins"), _mean("kda").alias("mean_kda")
    )


def form_trend(performance: DataFrame, matches: DataFrame, games: int = FORM_GAMES) -> DataFrame:
    """Mean KDA of each player's last games, as of every game with a known start."""
    started = matches.filter(F.col("game_creation").isNotNull()).select("match_id", "game_creation")
    rows = performance.select("match_id", "puuid", "kda").join(started, "match_id")
    numbered = running_index(stage(rows, "games"), ["puuid"], ["game_creation", "match_id"], "game_number", ties=[])
    return moving_mean(numbered, ["puuid"], "game_number", F.col("kda"), games, "form_kda")


def draft_analysis(draft: DataFrame) -> DataFrame:
    """Picks, bans and their share of all drafted matches, per champion."""
    total = draft.select("match_id").distinct().agg(F.count("*").alias("matches"))
    per_match = draft.groupBy("champion_id", "match_id").agg(
        F.count_if(F.col("type") == "pick").alias("picks"), F.count_if(F.col("type") == "ban").alias("bans")
    )
    per_champion = per_match.groupBy("champion_id").agg(
        F.sum("picks").alias("picks"), F.sum("bans").alias("bans"),
        F.count_if(F.col("picks") > 0).alias("picked_in"), F.count_if(F.col("bans") > 0).alias("banned_in"),
    )
    matches = total.scalar().cast("double")
    return per_champion.select(
        "champion_id", "picks", "bans",
        (F.col("picked_in").cast("double") / matches).alias("pick_rate"),
        (F.col("banned_in").cast("double") / matches).alias("ban_rate"),
    )
