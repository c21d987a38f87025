import datetime as dt

import pytest

from matchloom.plans import gold as g
from matchloom.plans import reports
from matchloom.schemas import GOLD, SILVER

D1, D2 = dt.date(2026, 3, 26), dt.date(2026, 3, 27)


@pytest.fixture
def make(spark):
    def build(table, *records):
        contract = SILVER[table]
        data = [tuple(r.get(c, D1 if c == "extraction_date" else None) for c in contract.columns) for r in records]
        return spark.createDataFrame(data, contract.schema)

    return build


@pytest.fixture
def matches(make):
    return make("matches", *[
        dict(match_id=m, game_duration_seconds=d, winning_team_id=100)
        for m, d in (("long", 1800), ("edge", 300), ("short", 299), ("unknown", None))])


def people(make, *records):
    base = dict(team_id=100, champion_id=1, champion_name="Ahri", kda=1.0, total_minions_killed=150,
                neutral_minions_killed=30, total_damage_dealt_to_champions=24_000, gold_earned=12_000)
    return make("match_participants", *[{**base, **r} for r in records])


def test_short_and_unknown_matches_are_left_out(make, matches, rows):
    teams = make("match_teams", *[dict(match_id=m, team_id=100, win=True)
                                  for m in ("long", "edge", "short", "unknown", "absent")])
    out = g.team_stats(teams, matches)
    assert rows(out, "match_id", "winning_team_id") == [("edge", 100), ("long", 100)]
    assert out.columns == GOLD["team_stats"].columns


def test_rates_and_untracked_players(make, matches):
    accounts = make("accounts", dict(puuid="p", game_name="P", tag_line="X", team="T"))
    facts = people(make, dict(match_id="long", puuid="p"), dict(match_id="long", puuid="stranger"))
    (row,) = g.player_performance(facts, matches, accounts).collect()
    assert (row.total_cs, row.gold_per_minute, row.damage_per_minute, row.cs_per_minute, row.damage_per_gold) == (
        180, 400.0, 800.0, 6.0, 2.0)
    assert (row.game_name, row.team) == ("P", "T")


def test_no_gold_divides_by_one(make, matches):
    accounts = make("accounts", dict(puuid="p"))
    row = g.player_performance(people(make, dict(match_id="long", puuid="p", gold_earned=0)), matches, accounts).first()
    assert row.damage_per_gold == 24_000.0 and row.gold_per_minute == 0.0


def test_facts_are_reduced_to_the_latest_row(make, matches):
    accounts = make("accounts", dict(puuid="p"))
    facts = people(make, dict(match_id="long", puuid="p", kills=1, extraction_date=D1),
                   dict(match_id="long", puuid="p", kills=9, extraction_date=D2))
    (row,) = g.player_performance(facts, matches, accounts).collect()
    assert row.kills == 9 and row.extraction_date == D2


def test_draft_positions_unknown_names_and_repeated_bans(make, matches, rows):
    teams = make("match_teams",
                 dict(match_id="long", team_id=100, bans=["7", "-1", "1", "7", "bad", None]),
                 dict(match_id="long", team_id=200, bans=[]), dict(match_id="long", team_id=300),
                 dict(match_id="short", team_id=100, bans=["1"]))
    facts = people(make, dict(match_id="long", puuid="p"), dict(match_id="short", puuid="p"),
                   dict(match_id="long", puuid="q", team_id=None))
    out = g.draft(teams, facts, matches)
    assert rows(out, "team_id", "champion_id", "champion_name", "type", "draft_order") == [
        (100, 1, "Ahri", "ban", 3), (100, 1, "Ahri", "pick", None), (100, 7, "UNKNOWN", "ban", 1)]


def test_champion_map_takes_the_most_recent_name(make, rows):
    facts = people(make, dict(match_id="a", puuid="p", champion_name="Old", extraction_date=D1),
                   dict(match_id="b", puuid="p", champion_name="New", extraction_date=D2),
                   dict(match_id="c", puuid="p", champion_name="Mew", extraction_date=D2),
                   dict(match_id="c", puuid="q", champion_id=None, champion_name="x"))
    assert rows(g.champion_map(facts)) == [(1, "New")]


def test_frames_are_numbered_without_gaps_across_hours(make, matches, rows):
    stamps = [0, 60_000, 3_599_999, 3_600_000, 7_300_000]
    frames = make("timeline_frames",
                  *[dict(match_id="long", participant_id=1, timestamp_ms=t) for t in reversed(stamps)],
                  dict(match_id="long", participant_id=2, timestamp_ms=5),
                  dict(match_id="long", participant_id=1, timestamp_ms=0, xp=1, extraction_date=D2),
                  dict(match_id="short", participant_id=1, timestamp_ms=0),
                  dict(match_id="lost", participant_id=1, timestamp_ms=0))
    facts = people(make, dict(match_id="long", puuid="old", participant_id=1, extraction_date=D1),
                   dict(match_id="long", puuid="new", participant_id=1, extraction_date=D2))
    out = g.player_frames_indexed(frames, facts, matches)
    assert rows(out, "participant_id", "frame_index", "timestamp_ms", "puuid") == [
        *[(1, i, t, "new") for i, t in enumerate(stamps, 1)], (2, 1, 5, None)]
    assert [r.xp for r in out.filter("participant_id = 1 AND frame_index = 1").collect()] == [1]


def test_reports(spark, make, matches, rows):
    accounts = make("accounts", dict(puuid="p"))
    many = make("matches", *[
        dict(match_id=f"m{i}", game_duration_seconds=600, game_creation=dt.datetime(2026, 1, 1 + i)) for i in range(7)])
    facts = people(make, *[dict(match_id=f"m{i}", puuid="p", kda=float(i), win=i % 2 == 0) for i in range(7)])
    teams = make("match_teams", *[dict(match_id=f"m{i}", team_id=100, win=True, bans=["9"]) for i in range(7)])
    performance = g.player_performance(facts, many, accounts)
    assert rows(reports.champion_pool(performance)) == [("p", 1, 7, 4, 3.0)]
    trend = reports.form_trend(performance, many).orderBy("game_number").collect()
    assert [r.form_kda for r in trend] == [0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0]
    draft = g.draft(teams, facts.filter("match_id <> 'm0'"), many)
    assert rows(reports.draft_analysis(draft)) == [(1, 6, 0, 6 / 7, 0.0), (9, 0, 7, 0.0, 1.0)]
