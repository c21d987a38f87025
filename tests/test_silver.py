"""Hand-written documents with the rows they must give."""

import datetime as dt
import json

import pytest

from matchloom.functions.documents import bad_documents
from matchloom.plans import silver as s
from matchloom.schemas import DOCUMENT, MATCH_DOCUMENT, SILVER

D1, D2 = dt.date(2026, 3, 26), dt.date(2026, 3, 27)


def team(team_id, win, bans="absent", kills=1):
    record = {"teamId": team_id, "win": win,
              "objectives": {k: {"first": True, "kills": kills}
                             for k in ("baron", "dragon", "tower", "inhibitor", "riftHerald")}}
    if bans != "absent":
        record["bans"] = bans if bans is None else [{"championId": b, "pickTurn": i} for i, b in enumerate(bans)]
    return record


def player(puuid, pid=1, **changes):
    record = {"participantId": pid, "puuid": puuid, "teamId": 100, "championName": "Ahri", "championId": 103,
              "role": "SOLO", "individualPosition": "MIDDLE", "kills": 4, "deaths": 2, "assists": 6,
              "goldEarned": 9000, "summoner1Id": 4, "summoner2Id": 14, "item0": 1, "win": True}
    record.update(changes)
    return record


def match(match_id, teams=(), participants=(), duration=1800, created=1_700_000_000_123):
    return json.dumps({"metadata": {"matchId": match_id, "dataVersion": "2"},
                       "info": {"gameCreation": created, "gameDuration": duration,
                                "gameEndTimestamp": created + 1000, "gameVersion": "14.1", "queueId": 420,
                                "teams": list(teams), "participants": list(participants)}})


@pytest.fixture
def bronze(spark):
    return lambda *docs: spark.createDataFrame(list(docs), DOCUMENT)


def parsed(bronze, *docs):
    return s.parsed_matches(bronze(*docs))


def test_match_fields_and_timestamp_keep_milliseconds(spark, bronze):
    row = s.matches(parsed(bronze, (match("M1", [team(100, True)]), D1))).first()
    assert (row.match_id, row.game_duration_seconds, row.queue_id, row.winning_team_id) == ("M1", 1800, 420, 100)
    assert row.extraction_date == D1
    ms = s.matches(parsed(bronze, (match("M1"), D1))).selectExpr("unix_millis(game_creation)").first()[0]
    assert ms == 1_700_000_000_123


def test_no_winner_and_missing_teams_give_null(bronze, rows):
    out = s.matches(parsed(bronze, (match("A", [team(100, False), team(200, False)]), D1), (match("B"), D1)))
    assert rows(out, "match_id", "winning_team_id") == [("A", None), ("B", None)]


def test_first_of_two_winners_is_taken(bronze):
    out = s.matches(parsed(bronze, (match("A", [team(200, True), team(100, True)]), D1)))
    assert out.first().winning_team_id == 200


def test_malformed_documents_are_left_out_and_reported(bronze):
    docs = bronze((match("A", [team(100, True)]), D1), ("{not json", D1), ("[]", D1), ('{"info": {}}', D1))
    assert s.matches(s.parsed_matches(docs)).count() == 1
    assert bad_documents(docs, MATCH_DOCUMENT, "metadata.matchId").count() == 3


def test_wrongly_typed_field_loses_only_that_field(bronze):
    doc = match("A", participants=[player("p", kills=1.5)])
    row = s.match_participants(parsed(bronze, (doc, D1))).first()
    assert row.kills is None and row.deaths == 2 and row.kda is None


def test_bans_become_strings_and_null_or_empty_lists_stay(bronze, rows):
    doc = match("A", [team(100, True, [157, -1, 157]), team(200, False, []), team(300, False, None),
                      team(400, False)])
    out = s.match_teams(parsed(bronze, (doc, D1)))
    assert rows(out, "team_id", "bans") == [
        (100, ["157", "-1", "157"]), (200, []), (300, None), (400, None)]


def test_team_without_id_is_left_out(bronze):
    assert s.match_teams(parsed(bronze, (match("A", [team(None, True), team(100, True)]), D1))).count() == 1


@pytest.mark.parametrize("deaths, kda", [(2, 5.0), (0, 10.0), (None, 10.0), (4, 2.5)])
def test_kda_divides_by_at_least_one(bronze, deaths, kda):
    out = s.match_participants(parsed(bronze, (match("A", participants=[player("p", deaths=deaths)]), D1)))
    assert out.first().kda == kda


def test_latest_landing_wins_and_equal_dates_do_not_depend_on_order(bronze, rows):
    old, new = match("A", duration=299), match("A", duration=1800)
    for docs in ([(old, D1), (new, D2)], [(new, D2), (old, D1)]):
        assert s.matches(parsed(bronze, *docs)).first().game_duration_seconds == 1800
    for docs in ([(old, D1), (new, D1)], [(new, D1), (old, D1)]):
        assert s.matches(parsed(bronze, *docs)).first().game_duration_seconds == 1800


def test_every_builder_keeps_its_contract(bronze):
    doc = match("A", [team(100, True, [1])], [player("p")])
    for name in ("matches", "match_teams", "match_participants"):
        out = getattr(s, name)(parsed(bronze, (doc, D1)))
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in SILVER[name].schema]
        assert out.count() == 1


def test_accounts_from_arrays_and_single_objects(bronze, rows):
    landed = json.dumps([
        {"team": "T1", "role": "mid", "game_name": "asked", "tag_line": "X", "puuid": "p1",
         "game_name_api": "Answered", "tag_line_api": "Y", "extracted_at": "now"},
        {"team": "T1", "role": "top", "game_name": "only", "tag_line": "Z", "puuid": "p2"},
        {"team": "T1", "game_name": "unresolved"}])
    single = json.dumps({"puuid": "p3", "gameName": "Solo", "tagLine": "W", "summonerLevel": 30, "profileIconId": 7})
    out = s.accounts(bronze((landed, D1), (single, D1)))
    assert rows(out, "puuid", "game_name", "tag_line", "team", "roster_role", "summoner_level") == [
        ("p1", "Answered", "Y", "T1", "mid", None), ("p2", "only", "Z", "T1", "top", None),
        ("p3", "Solo", "W", None, None, 30)]


def test_participant_ids_smallest_or_latest(bronze, rows):
    docs = [(match("A", participants=[player("p", 3)]), D1), (match("A", participants=[player("p", 7)]), D2),
            (match("A", participants=[player("q", None)]), D2)]
    assert rows(s.participant_ids_first(parsed(bronze, *docs))) == [("A", "p", 3)]
    assert rows(s.participant_ids_latest(bronze(*docs))) == [("A", "p", 7), ("A", "q", None)]


def timeline(match_id, frames):
    return json.dumps({"metadata": {"matchId": match_id}, "info": {"frames": frames}})


def test_timeline_frames_from_the_keyed_map(bronze, rows):
    frame = {"currentGold": 500, "totalGold": 600, "xp": 5, "level": 1, "minionsKilled": 2,
             "jungleMinionsKilled": 0, "position": {"x": 10, "y": 20}}
    doc = timeline("A", [
        {"timestamp": 0, "participantFrames": {"1": frame, "2": {**frame, "xp": 9}}},
        {"timestamp": 60_012, "participantFrames": {"1": frame}},
        {"timestamp": 120_000, "participantFrames": {}}, {"timestamp": 180_000}])
    out = s.timeline_frames(s.parsed_timelines(bronze((doc, D1))))
    assert rows(out, "participant_id", "timestamp_ms", "minute", "xp", "position_y") == [
        (1, 0, 0, 5, 20), (1, 60_012, 1, 5, 20), (2, 0, 0, 9, 20)]


def test_timeline_events_keep_their_place_in_the_frame(bronze, rows):
    doc = timeline("A", [
        {"timestamp": 0, "events": []},
        {"timestamp": 60_000, "events": [
            {"timestamp": 59_000, "type": "ITEM_PURCHASED", "itemId": 1001},
            {"timestamp": 59_000, "type": "CHAMPION_KILL", "killerId": 1, "victimId": 6,
             "assistingParticipantIds": [2, 3], "position": {"x": 1, "y": 2}},
            {"type": "WARD_PLACED", "wardType": "YELLOW_TRINKET"}]}])
    out = s.timeline_events(s.parsed_timelines(bronze((doc, D1))))
    assert rows(out, "timestamp_ms", "event_index", "minute", "type", "assisting_participant_ids") == [
        (59_000, 0, 0, "ITEM_PURCHASED", None), (59_000, 1, 0, "CHAMPION_KILL", [2, 3]),
        (60_000, 2, 1, "WARD_PLACED", None)]


def test_absurd_numbers_give_null_instead_of_stopping_the_job(bronze):
    docs = s.matches(parsed(bronze, (match("A", created=9 * 10**18), D1)))
    assert docs.first().game_creation is None
    late = timeline("A", [{"timestamp": 2**62, "participantFrames": {"1": {"xp": 1}}}])
    assert s.timeline_frames(s.parsed_timelines(bronze((late, D1)))).first().minute is None
