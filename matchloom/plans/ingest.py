"""The dataflow ahead of bronze: accounts, match ids, documents still to fetch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchloom.functions.documents import player_label
from matchloom.operators.aggregates import outcome_counts
from matchloom.operators.keys import top_n_by_key
from matchloom.operators.quality import observe_counts
from matchloom.operators.upsert import new_rows
from matchloom.schemas import MATCHES_PER_PLAYER, RANKED_QUEUE


def enrich_accounts(roster: DataFrame, resolved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split the roster into enriched accounts and players that did not resolve.

    ``resolved`` holds the replies: the name and tag asked for, and the puuid,
    name and tag answered; a missing answer falls back to the roster's value.
    """
    joined = roster.join(resolved, ["game_name", "tag_line"], "left")
    found = joined.filter(F.col("puuid").isNotNull()).select(
        "team", "role", "game_name", "tag_line", "puuid",
        F.coalesce("game_name_api", "game_name").alias("game_name_api"),
        F.coalesce("tag_line_api", "tag_line").alias("tag_line_api"),
    )
    failed = joined.filter(F.col("puuid").isNull()).select("team", "role", "game_name", "tag_line")
    return found, failed


def latest_matches(
    played: DataFrame, player: str = "puuid", n: int = MATCHES_PER_PLAYER, queue: int | None = RANKED_QUEUE
) -> DataFrame:
    """Each player's most recent ranked matches, with their ``place`` from 1."""
    rows = played if queue is None else played.filter(F.col("queue_id") == queue)
    order = [F.desc("game_creation"), F.desc("match_id")]
    return top_n_by_key(rows, [player], order, n, rank="place")


def unique_match_ids(lists: DataFrame) -> DataFrame:
    """Distinct ids over all players, in ascending order."""
    return lists.select("match_id").distinct().orderBy("match_id")


def player_match_map(latest: DataFrame, player: Column | None = None, key: str = "puuid") -> DataFrame:
    """Player → ids, most recent first, all that ``latest`` holds.

    Takes the result of ``latest_matches``, which bounds how many a player has. Players are told apart by ``key``
    and shown by their label, which two of them may share.
    """
    label = player_label() if player is None else player
    ranked = latest.groupBy(F.col(key), label.alias("player")).agg(
        F.sort_array(F.collect_list(F.struct("place", "match_id"))).alias("ranked")
    )
    return ranked.select("player", F.col("ranked.match_id").alias("match_ids"))


def new_ids_per_player(lists: DataFrame, roster_order: str, player: str) -> DataFrame:
    """How many ids each player is the first, in roster order, to contribute."""
    first = lists.groupBy("match_id").agg(F.min(F.struct(roster_order, player)).alias("first"))
    return first.groupBy(F.col(f"first.{player}").alias(player)).agg(F.count("*").alias("new_ids"))


def to_fetch(match_ids: DataFrame, landed: DataFrame) -> DataFrame:
    """Ids whose document has not landed; matches and timelines are asked separately."""
    return new_rows(match_ids, landed, ["match_id"])


OUTCOMES = ("skipped", "success", "failed")


def marked_outcomes(match_ids: DataFrame, landed: DataFrame, fetched: DataFrame) -> DataFrame:
    """Each id with its ``status``: landed before, fetched now, or neither."""
    before = landed.select("match_id").distinct().withColumn("was_landed", F.lit(True))
    now = fetched.select("match_id").distinct().withColumn("was_fetched", F.lit(True))
    marked = match_ids.join(before, "match_id", "left").join(now, "match_id", "left")
    status = (
        F.when(F.col("was_landed"), "skipped").when(F.col("was_fetched"), "success").otherwise("failed")
    )
    return marked.withColumn("status", status)


def fetch_outcomes(match_ids: DataFrame, landed: DataFrame, fetched: DataFrame) -> DataFrame:
    """Counts of skipped, successful and failed documents."""
    return outcome_counts(marked_outcomes(match_ids, landed, fetched), "status")


def record_outcomes(match_ids: DataFrame, landed: DataFrame, fetched: DataFrame, path: str) -> dict[str, int]:
    """Write the ids by status, and count them while they are written: no second scan, all three counts at once."""
    marked = marked_outcomes(match_ids, landed, fetched).select("match_id", "status")
    rows, counts = observe_counts(marked, {status: F.col("status") == status for status in OUTCOMES})
    rows.write.mode("overwrite").partitionBy("status").parquet(path)
    return counts()
