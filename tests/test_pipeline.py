"""Landing files through to gold: repeated, reordered and late runs."""

import datetime as dt
import json
import threading
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from test_silver import match, player, team, timeline

from matchloom.operators.quality import ContractViolation
from matchloom.plans import silver as s
from matchloom.plans.pipeline import Lakehouse, amend_participant_ids, amend_silver, run, run_bronze, run_gold, run_silver
from matchloom.schemas import DOCUMENT, GOLD, SILVER
from matchloom.session import HASH_JOINS, scratch, settings, stage, together
from matchloom.sources import landing as l
from matchloom.sources.tables import read_table, write_upsert
from matchloom.streaming.incremental import append_bronze, stream_documents, upsert_stream

D1, D2 = "2026-03-26", "2026-03-27"


def put(base, entity, day, name, text):
    folder = base / entity / f"dt={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def ten(kills=4):
    return [player(f"p{i}", i, teamId=100 if i <= 5 else 200, championId=i, championName=f"C{i}", kills=kills)
            for i in range(1, 11)]


def frames(n):
    entry = {"currentGold": 1, "totalGold": 2, "xp": 3, "level": 4, "position": {"x": 1, "y": 2}}
    return [{"timestamp": i * 60_000, "participantFrames": {str(p): entry for p in range(1, 11)},
             "events": [{"timestamp": i * 60_000, "type": "PAUSE_END"}]} for i in range(n)]


@pytest.fixture
def landing(tmp_path):
    base = tmp_path / "landing"
    records = [{"team": "T", "role": "mid", "game_name": f"n{i}", "tag_line": "X", "puuid": f"p{i}"}
               for i in range(1, 11)]
    put(base, "accounts", D1, "accounts.json", json.dumps(records, indent=2))
    teams = [team(100, True, [77, -1]), team(200, False, [1, 77])]
    put(base, "matches", D1, "A.json", match("A", teams, ten()))
    put(base, "matches", D1, "B.json", match("B", teams, ten(), duration=299))
    put(base, "matches", D1, "broken.json", "{")
    put(base, "matches", D1, "notes.txt", match("IGNORED"))
    put(base, "timelines", D1, "A_timeline.json", timeline("A", frames(3)))
    return base


def contents(spark, root):
    return {c.name: sorted(map(str, read_table(spark, root, c).collect())) for c in [*SILVER.values(), *GOLD.values()]}


def test_a_run_a_second_run_and_a_clean_report(spark, tmp_path, landing):
    root = str(tmp_path / "lake")
    report = run(spark, str(landing), root, D1, on_violation="raise")
    assert {(r.table_name, r.rule, r.violations) for r in report.filter("violations > 0").collect()} == {
        ("bronze_matches", "rejected_documents", 1)}  # the broken file
    first = contents(spark, root)
    assert {t: len(first[t]) for t in GOLD} == {
        "team_stats": 2, "player_performance": 10, "draft": 13, "player_frames_indexed": 30}
    assert len(first["matches"]) == 2 and len(first["timeline_events"]) == 3
    run(spark, str(landing), root, D1)
    assert contents(spark, root) == first


def test_a_later_day_updates_and_adds_without_deleting(spark, tmp_path, landing):
    root = str(tmp_path / "lake")
    run(spark, str(landing), root, D1)
    teams = [team(100, False), team(200, True)]
    put(landing, "accounts", D2, "accounts.json", json.dumps([{"puuid": "p1", "game_name": "renamed"}]))
    put(landing, "matches", D2, "A.json", match("A", teams, ten(kills=9)))
    put(landing, "matches", D2, "C.json", match("C", teams, ten()))
    put(landing, "timelines", D2, "C_timeline.json", timeline("C", frames(2)))
    run(spark, str(landing), root, D2)
    performance = read_table(spark, root, GOLD["player_performance"])
    assert performance.count() == 20
    assert {r.kills for r in performance.filter("match_id = 'A'").collect()} == {9}
    assert performance.filter("game_name = 'renamed'").count() == 2
    assert read_table(spark, root, GOLD["player_frames_indexed"]).count() == 50
    assert read_table(spark, root, SILVER["matches"]).filter("match_id = 'B'").count() == 1


def test_rejected_documents_are_kept_with_their_reason(spark, tmp_path, landing, rows):
    put(landing, "matches", D1, "empty.json", " ")
    put(landing, "matches", D2, "list.json", '{"info": {"gameDuration": 5}}')
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    run_bronze(lake, str(landing))
    run_silver(lake)
    first = [(" ", "empty document"), ('{"info": {"gameDuration": 5}}', "no matchId"), ("{", "malformed JSON")]
    assert rows(lake.rejects("matches"), "raw_json", "reason") == first
    assert lake.rejects("timelines").count() == 0
    put(landing, "matches", D1, "broken.json", match("NEW"))
    put(landing, "matches", D1, "empty.json", match("NEW2"))
    run_bronze(lake, str(landing), D1)
    run_silver(lake, D1)
    assert rows(lake.rejects("matches"), "raw_json", "reason") == first[1:2]


def test_partial_gold_builds_equal_a_full_build(spark, tmp_path, landing):
    put(landing, "accounts", D2, "accounts.json", "[]")
    put(landing, "matches", D2, "C.json", match("C", [team(100, True), team(200, False)], ten()))
    put(landing, "timelines", D2, "C_timeline.json", timeline("C", frames(2)))
    whole, parts = (Lakehouse(spark, str(tmp_path / n)) for n in ("whole", "parts"))
    run_bronze(whole, str(landing))
    run_silver(whole)
    run_gold(whole)
    for day, since in ((D1, None), (D2, D2)):
        run_bronze(parts, str(landing), day)
        run_silver(parts, day)
        run_gold(parts, since)
    assert contents(spark, parts.root) == contents(spark, whole.root)


def test_fail_fast_policy(spark, tmp_path, landing):
    put(landing, "matches", D1, "odd.json", match("ODD", [team(300, True)], ten()))
    lines = []
    with pytest.raises(ContractViolation, match="silver_match_teams.dq_team_domain: 1"):
        run(spark, str(landing), str(tmp_path / "lake"), D1, on_violation="raise", log=lines.append)
    assert any("dq_two_teams" in line for line in lines)


def test_participant_id_backfill_fills_only_gaps(spark, rows):
    bronze = spark.createDataFrame([(match("A", participants=ten()), dt.date(2026, 3, 26))], DOCUMENT)
    full = s.match_participants(s.parsed_matches(bronze))
    amended = amend_participant_ids(full.drop("participant_id"), bronze)
    assert rows(amended, "puuid", "participant_id") == rows(full, "puuid", "participant_id")
    wrong = spark.createDataFrame([("A", "p1", 99), ("A", "p2", None)], "match_id string, puuid string, participant_id int")
    assert rows(amend_participant_ids(wrong, bronze)) == [("A", "p1", 99), ("A", "p2", 2)]


def test_landing_reader_prunes_days_and_reads_missing_days_as_empty(spark, landing):
    docs = l.read_documents(spark, str(landing), "matches", D1)
    assert docs.columns == ["raw_json", "extraction_date"] and docs.count() == 3
    assert l.read_documents(spark, str(landing), "matches", "2026-01-01").count() == 0
    assert "PartitionFilters: [isnotnull(dt" in docs._jdf.queryExecution().executedPlan().toString()
    roster = l.read_day(spark, str(landing), "accounts", D1, l.ROSTER)
    assert roster.count() == 10 and l.read_day(spark, str(landing), "accounts", "2026-01-01", l.ROSTER).count() == 0
    assert l.read_roster(spark, str(landing / "accounts" / f"dt={D1}" / "accounts.json")).first().role == "mid"


def test_landed_json_round_trip_replaces_only_its_days(spark, tmp_path):
    base = str(tmp_path)
    both = spark.createDataFrame([("a", D1), ("b", D2)], "v string, dt string")
    l.land_json(both, base, "x")
    l.land_json(spark.createDataFrame([("c", D2)], "v string, dt string"), base, "x")
    got = {(r.raw_json, str(r.extraction_date)) for r in l.read_documents(spark, base, "x", whole_file=False).collect()}
    assert got == {('{"v":"a"}', D1), ('{"v":"c"}', D2)}


def test_stream_loads_every_file_once(spark, tmp_path, landing):
    path, checkpoint = str(tmp_path / "bronze"), str(tmp_path / "checkpoint")

    def load():
        append_bronze(stream_documents(spark, str(landing), "matches"), path, checkpoint).awaitTermination()
        return l.read_bronze(spark, path).count()

    assert (load(), load()) == (3, 3)
    put(landing, "matches", D2, "C.json", match("C"))
    assert load() == 4


def test_stream_and_batch_share_a_bronze_table_in_any_order(spark, tmp_path, landing):
    put(landing, "matches", D2, "C.json", match("C"))

    def batch(path):
        l.load_bronze(l.read_documents(spark, str(landing), "matches", D2), path)

    def stream(path):
        docs = stream_documents(spark, str(landing), "matches", max_files=1).filter(f"extraction_date < '{D2}'")
        append_bronze(docs, path, f"{path}-checkpoint").awaitTermination()

    whole = sorted(r.raw_json for r in l.read_documents(spark, str(landing), "matches").collect())
    for i, steps in enumerate([(batch, stream), (stream, batch), (stream, batch, batch, stream)]):
        path = str(tmp_path / f"bronze{i}")
        for step in steps:
            step(path)
        assert sorted(r.raw_json for r in l.read_bronze(spark, path).collect()) == whole


def test_nothing_staged_stays_after_a_run_or_a_stream(spark, tmp_path, landing):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before = set(folder.glob("stage-*"))
    report = run(spark, str(landing), str(tmp_path / "lake"))
    run(spark, str(landing), str(tmp_path / "lake"), D1, gold_since=D1)
    upsert_stream(stream_documents(spark, str(landing), "matches", max_files=1),
                  lambda b: s.matches(s.parsed_matches(b)), SILVER["matches"], str(tmp_path / "other"),
                  str(tmp_path / "checkpoint")).awaitTermination()
    assert set(folder.glob("stage-*")) == before
    assert report.count() > 0


def test_id_lists_are_loaded_where_they_land(spark, tmp_path, landing):
    put(landing, "match_ids", D1, "match_ids.json", '["A", "B"]')
    lake = Lakehouse(spark, str(tmp_path / "lake"))
    run_bronze(lake, str(landing), D1)
    assert [r.raw_json for r in lake.bronze("match_ids").collect()] == ['["A", "B"]']


def test_a_run_fills_participant_ids_that_stored_rows_lack(spark, tmp_path, landing):
    root, contract = str(tmp_path / "lake"), SILVER["match_participants"]
    run(spark, str(landing), root, D1)
    first = contents(spark, root)
    stored = read_table(spark, root, contract)
    emptied = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in stored.collect()], contract.schema)
    write_upsert(emptied, contract, root)
    amend_silver(Lakehouse(spark, root))
    assert contents(spark, root) == first


def test_stream_upsert_keeps_the_latest_extraction_in_any_order(spark, tmp_path, landing):
    contract, root, checkpoint = SILVER["matches"], str(tmp_path / "lake"), str(tmp_path / "checkpoint")

    def load():
        upsert_stream(stream_documents(spark, str(landing), "matches", max_files=1),
                      lambda b: s.matches(s.parsed_matches(b)), contract, root, checkpoint).awaitTermination()
        return {r.match_id: r.game_duration_seconds for r in read_table(spark, root, contract).collect()}

    put(landing, "matches", D2, "A.json", match("A", duration=2000))
    assert load() == {"A": 2000, "B": 299}
    put(landing, "matches", "2026-03-25", "A.json", match("A", duration=1))
    assert load() == {"A": 2000, "B": 299}


def test_an_older_day_loaded_second_changes_nothing_newer(spark, tmp_path, landing):
    root = str(tmp_path / "lake")
    put(landing, "matches", D2, "A.json", match("A", [team(100, False), team(200, True)], ten(kills=9)))
    for day in (D2, D1):
        run(spark, str(landing), root, day)
    participants = read_table(spark, root, SILVER["match_participants"]).filter("match_id = 'A'")
    assert {r.kills for r in participants.collect()} == {9}


@pytest.mark.parametrize("since", [None, D2])
def test_a_match_that_no_longer_counts_leaves_gold(spark, tmp_path, landing, since):
    root = str(tmp_path / "lake")
    run(spark, str(landing), root, D1)
    put(landing, "matches", D2, "A.json", match("A", [team(100, True), team(200, False)], ten(), duration=120))
    run(spark, str(landing), root, D2, gold_since=since)
    assert {t: read_table(spark, root, c).count() for t, c in GOLD.items()} == dict.fromkeys(GOLD, 0)


def test_older_matches_of_a_newly_tracked_player_reach_a_partial_build(spark, tmp_path, landing):
    root = str(tmp_path / "lake")
    teams = [team(100, True), team(200, False)]
    people = [*ten()[:9], player("late", 10, teamId=200, championId=10, championName="C10")]
    put(landing, "matches", D1, "C.json", match("C", teams, people))
    run(spark, str(landing), root, D1)
    performance = lambda: read_table(spark, root, GOLD["player_performance"])
    assert performance().filter("puuid = 'late'").count() == 0
    before = performance().count()
    put(landing, "accounts", D2, "accounts.json", json.dumps([{"puuid": "late", "game_name": "late"}]))
    run(spark, str(landing), root, D2, gold_since=D2)
    assert performance().filter("puuid = 'late'").count() == 1
    assert performance().count() == before + 1


def test_tables_that_need_nothing_of_each_other_are_built_at_the_same_time(spark, tmp_path, landing, monkeypatch):
    """pipe_gold built one table after another, so cores were idle at the end of every stage."""
    from matchloom.plans import pipeline

    lake, inside, most, lock = Lakehouse(spark, str(tmp_path / "lake")), set(), [], threading.Lock()
    met = threading.Barrier(2)

    def watched(write):
        def run_one(rows, contract, *more, **named):
            with lock:
                inside.add(contract.name)
                most.append(sorted(inside))
            if contract.name in ("matches", "match_teams", "draft", "team_stats"):
                met.wait(60)
            try:
                return write(rows, contract, *more, **named)
            finally:
                with lock:
                    inside.remove(contract.name)
        return run_one

    for name in ("write_upsert", "write_all"):
        monkeypatch.setattr(pipeline, name, watched(getattr(pipeline, name)))
    run_bronze(lake, str(landing), D1)
    run_silver(lake)
    run_gold(lake)
    alone = ("match_participants", "player_performance")
    assert all(names == [name] for name in alone for names in most if name in names)
    assert {c.name: read_table(spark, lake.root, c).count() for c in GOLD.values()} == {
        "team_stats": 2, "player_performance": 10, "draft": 13, "player_frames_indexed": 30,
    }


def test_jobs_at_the_same_time_stage_for_their_caller_and_end_before_an_error(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file://"))
    before, ended = set(folder.glob("stage-*")), []

    def broken():
        raise ValueError("one")

    with scratch(spark):
        first, second = together(spark, lambda: stage(spark.range(3), "a"), lambda: stage(spark.range(4), "b"))
        assert (first.count(), second.count()) == (3, 4)  # staged for the block, not for the job
        with pytest.raises(ValueError, match="one"):
            together(spark, broken, lambda: ended.append(stage(spark.range(5), "c").count()))
        assert ended == [5]
    assert set(folder.glob("stage-*")) == before


def test_gold_looks_large_dimensions_up_without_sorting_the_facts(spark, tmp_path, landing, monkeypatch):
    """the facts were sorted once more for each join with a table too large to broadcast."""
    from matchloom.plans import pipeline

    plans, key = {}, next(iter(HASH_JOINS))

    def planned(rows, contract, root):
        rows.collect()
        plans[contract.name] = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    lake = Lakehouse(spark, str(tmp_path / "lake"))
    run_bronze(lake, str(landing), D1)
    run_silver(lake)
    monkeypatch.setattr(pipeline, "write_all", planned)
    was = spark.conf.get(key)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        run_gold(lake)
    assert spark.conf.get(key) == was
    assert "ShuffledHashJoin" in plans["team_stats"] and "SortMergeJoin" not in plans["team_stats"]
    assert "ShuffledHashJoin" in plans["player_performance"] and "SortMergeJoin" not in plans["player_performance"]


def test_what_is_staged_has_no_dictionaries(spark):
    """they took a good part of the time of the step that parses the documents."""
    with scratch(spark):
        files = [f.removeprefix("file://") for f in stage(spark.range(100).selectExpr("id % 3 AS a", "'x' AS b"), "plain").inputFiles()]
        for file in files:
            group = pq.read_metadata(file).row_group(0)
            for column in range(2):
                assert group.column(column).compression == "ZSTD"
                assert not any("DICTIONARY" in e for e in group.column(column).encodings)
