from matchloom.functions.documents import player_label
from matchloom.plans import ingest


def test_accounts_are_enriched_and_failures_kept_apart(spark, rows):
    roster = spark.createDataFrame([("T", "mid", "a", "X"), ("T", "top", "b", "X"), ("U", "top", "c", "Y")],
                                   "team string, role string, game_name string, tag_line string")
    replies = spark.createDataFrame([("a", "X", "p1", "A!", None), ("b", "X", None, None, None)],
                                    "game_name string, tag_line string, puuid string, game_name_api string, tag_line_api string")
    found, failed = ingest.enrich_accounts(roster, replies)
    assert rows(found) == [("T", "mid", "a", "X", "p1", "A!", "X")]
    assert rows(failed, "game_name") == [("b",), ("c",)]


def test_latest_matches_filters_the_queue_and_keeps_n(spark, rows):
    played = spark.createDataFrame([("p", f"M{i:02}", i, 420 if i % 2 else 440) for i in range(60)],
                                   "puuid string, match_id string, game_creation int, queue_id int")
    latest = ingest.latest_matches(played)
    assert latest.count() == 20 and rows(latest.filter("place = 1"), "match_id") == [("M59",)]
    assert ingest.latest_matches(played, n=100, queue=None).count() == 60


def test_ids_are_unique_over_players_and_sorted(spark):
    lists = spark.createDataFrame([("a", "M3"), ("a", "M1"), ("b", "M1"), ("b", "M2")], "player string, match_id string")
    assert [r.match_id for r in ingest.unique_match_ids(lists).collect()] == ["M1", "M2", "M3"]


def test_player_map_is_most_recent_first(spark, rows):
    latest = spark.createDataFrame([("1", "T", "a", "M1", 2), ("1", "T", "a", "M9", 1), ("2", "T", "b", "M1", 1)],
                                   "puuid string, team string, game_name string, match_id string, place int")
    assert rows(ingest.player_match_map(latest, player_label())) == [("T/a", ["M9", "M1"]), ("T/b", ["M1"])]


def test_player_map_keeps_all_ids_and_players_with_one_label_apart(spark, rows):
    latest = spark.createDataFrame([(p, "T", "a", f"M{i:02}", i) for p in "12" for i in range(1, 51)],
                                   "puuid string, team string, game_name string, match_id string, place int")
    assert rows(ingest.player_match_map(latest, player_label())) == [("T/a", [f"M{i:02}" for i in range(1, 51)])] * 2


def test_new_ids_go_to_the_first_player_of_the_roster(spark, rows):
    lists = spark.createDataFrame([(1, "a", "M1"), (2, "b", "M1"), (2, "b", "M2"), (3, "c", "M2")],
                                  "ord int, player string, match_id string")
    assert rows(ingest.new_ids_per_player(lists, "ord", "player")) == [("a", 1), ("b", 1)]


def test_only_missing_documents_are_fetched_per_entity(spark, rows, tmp_path):
    ids = spark.createDataFrame([("A",), ("B",), ("C",)], "match_id string")
    matches, timelines = ids.filter("match_id = 'A'"), ids.filter("match_id = 'B'")
    assert rows(ingest.to_fetch(ids, matches)) == [("B",), ("C",)]
    assert rows(ingest.to_fetch(ids, timelines)) == [("A",), ("C",)]
    assert rows(ingest.fetch_outcomes(ids, matches, ids.filter("match_id = 'B'"))) == [
        ("failed", 1), ("skipped", 1), ("success", 1)]
    path = str(tmp_path / "outcomes")
    assert ingest.record_outcomes(ids, matches, ids.filter("match_id = 'B'"), path) == {"skipped": 1, "success": 1, "failed": 1}
    assert rows(spark.read.parquet(path), "match_id", "status") == [("A", "skipped"), ("B", "success"), ("C", "failed")]
    assert ingest.record_outcomes(ids.limit(0), matches, matches, path) == {"skipped": 0, "success": 0, "failed": 0}
