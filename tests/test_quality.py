"""Every rule with an input that keeps it and one that breaks it."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from matchloom.operators.quality import (
    ContractViolation, DistinctPerGroupRule, ForeignKeyRule, FrameDensityRule, GroupRule, NotEmptyRule, RowRule, UniqueRule,
    check, not_in, observe_counts, pk_not_null, settle,
)
from matchloom.plans.validation import gold_references, gold_rules, silver_references, silver_rules
from matchloom.schemas import GOLD, SILVER
from matchloom.workloads.inputs import Layers


@pytest.fixture
def make(spark):
    def build(contract, records):
        data = [tuple(r.get(c) for c in contract.columns) for r in records]
        return spark.createDataFrame(data, contract.schema)

    return build


def violations(report):
    return {r.rule: r.violations for r in report.collect()}


CREATED = dt.datetime(2026, 1, 1)
TEAMS = [dict(match_id="m", team_id=t, win=t == 100, game_duration_seconds=1800) for t in (100, 200)]
PEOPLE = [dict(match_id="m", puuid=f"p{i}", participant_id=i, team_id=100, kda=1.0) for i in range(1, 11)]
PLAYERS = [dict(match_id="m", puuid=f"p{i}", gold_earned=1, gold_per_minute=1.0, damage_per_minute=1.0,
                cs_per_minute=1.0, damage_per_gold=1.0, game_duration_seconds=300) for i in range(10)]
DRAFT = [dict(match_id="m", team_id=100, champion_id=i, type="pick") for i in range(1, 11)]
FRAMES = [dict(match_id="m", participant_id=p, frame_index=i) for p in range(1, 11) for i in (1, 2)]
MOMENTS = [dict(match_id="m", participant_id=1, timestamp_ms=0, minute=0, event_index=0)]

SINGLE = [
    # layer, table, good rows, rule, bad rows, violations
    ("silver", "accounts", [dict(puuid="p")], "dq_pk_not_null", [dict(puuid=None)], 1),
    ("silver", "accounts", [dict(puuid="p")], "dq_not_empty", [], 1),
    ("silver", "accounts", [dict(puuid="p")], "dq_pk_unique", [dict(puuid="p")] * 3, 2),
    ("silver", "matches", [dict(match_id="m", game_creation=CREATED)], "dq_ts_range",
     [dict(match_id="m", game_creation=dt.datetime(2019, 12, 31))], 1),
    ("silver", "match_teams", TEAMS, "dq_team_domain", [dict(match_id="m", team_id=300)], 1),
    ("silver", "match_teams", TEAMS, "dq_silver_two_teams", TEAMS[:1], 1),
    ("silver", "match_participants", PEOPLE, "dq_kda_nonneg", [dict(match_id="m", puuid="p", kda=-1.0)], 1),
    ("silver", "match_participants", PEOPLE, "dq_pid_populated", [dict(match_id="m", puuid="p")], 1),
    ("silver", "match_participants", PEOPLE, "dq_pid_range", [dict(match_id="m", participant_id=11)], 1),
    ("silver", "match_participants", PEOPLE, "dq_silver_ten_participants", PEOPLE[:9], 1),
    ("silver", "timeline_frames", MOMENTS, "dq_minute_nonneg", [dict(match_id="m", minute=-1)], 1),
    ("silver", "timeline_events", MOMENTS, "dq_minute_nonneg", [dict(match_id="m", minute=-1)], 1),
    ("gold", "team_stats", TEAMS, "dq_two_teams", TEAMS + [dict(match_id="m", team_id=300)], 1),
    ("gold", "team_stats", TEAMS, "dq_team_domain", [dict(match_id="m", team_id=1)], 1),
    ("gold", "team_stats", TEAMS, "dq_no_remake", [dict(match_id="m", game_duration_seconds=299)], 1),
    ("gold", "player_performance", PLAYERS, "dq_ten_players", PLAYERS[:3], 1),
    ("gold", "player_performance", PLAYERS, "dq_player_count", PLAYERS + [dict(match_id="m", puuid="x")], 1),
    ("gold", "player_performance", PLAYERS, "dq_gold_earned_pos", [dict(match_id="m", gold_earned=0)], 1),
    ("gold", "player_performance", PLAYERS, "dq_rates_nonneg", [dict(match_id="m", cs_per_minute=-0.1)], 1),
    ("gold", "draft", DRAFT, "dq_draft_type", [dict(match_id="m", type="swap"), dict(match_id="m")], 1),
    ("gold", "draft", DRAFT, "dq_no_sentinel", [dict(match_id="m", champion_id=-1)], 1),
    ("gold", "draft", DRAFT, "dq_draft_count", DRAFT[:9], 1),
    ("gold", "player_frames_indexed", FRAMES, "dq_frame_gapless",
     [dict(match_id="m", participant_id=1, frame_index=2)], 1),
    ("gold", "player_frames_indexed", FRAMES, "dq_pid_range", [dict(match_id="m", participant_id=0)], 1),
    ("gold", "player_frames_indexed", FRAMES, "dq_ten_pids", FRAMES[:2], 1),
]


@pytest.mark.parametrize("layer, table, good, rule, bad, n", SINGLE, ids=lambda v: v if isinstance(v, str) else "")
def test_single_table_rules(make, layer, table, good, rule, bad, n):
    contract = (SILVER if layer == "silver" else GOLD)[table]
    rules = [r for r in (silver_rules if layer == "silver" else gold_rules)(table) if r.name == rule]
    assert violations(check(table, make(contract, good), rules)) == {rule: 0}
    assert violations(check(table, make(contract, bad), rules)) == {rule: n}


def _silver(make, **changes):
    records = {"accounts": [dict(puuid=f"p{i}") for i in range(1, 11)],
               "matches": [dict(match_id="m", winning_team_id=100)],
               "match_participants": PEOPLE, **changes}
    return {t: make(SILVER[t], records.get(t, [])) for t in SILVER}


REFERENCES = [
    ("silver", "match_teams", "dq_silver_fk_team_match"),
    ("silver", "match_participants", "dq_silver_fk_participant_match"),
    ("silver", "timeline_frames", "dq_silver_fk_frame_match"),
    ("silver", "timeline_events", "dq_silver_fk_event_match"),
    ("silver", "match_participants", "dq_silver_fk_participant_account"),
    ("gold", "team_stats", "dq_fk_team_match"),
    ("gold", "player_performance", "dq_fk_player_match"),
    ("gold", "player_performance", "dq_fk_player_account"),
    ("gold", "player_frames_indexed", "dq_fk_frame_participant"),
]


@pytest.mark.parametrize("layer, table, rule", REFERENCES, ids=lambda v: v)
def test_foreign_keys_count_distinct_orphans(make, layer, table, rule):
    contract = (SILVER if layer == "silver" else GOLD)[table]
    references = (silver_references if layer == "silver" else gold_references)(_silver(make))
    rules = [r for r in references[table] if r.name == rule]
    good = make(contract, [dict(match_id="m", puuid="p1", participant_id=1)])
    bad = make(contract, [dict(match_id="x", puuid="x", participant_id=99)] * 2)
    assert violations(check(table, good, rules)) == {rule: 0}
    assert violations(check(table, bad, rules)) == {rule: 1}


@pytest.mark.parametrize("win, expected", [((True, False), (0, 0)), ((False, True), (1, 1)), ((True, True), (0, 1))])
def test_win_coherence_in_both_directions(make, win, expected):
    rules = [r for r in gold_references(_silver(make))["team_stats"] if r.name.startswith("dq_win")]
    stats = make(GOLD["team_stats"], [dict(match_id="m", team_id=t, win=w) for t, w in zip((100, 200), win)])
    found = violations(check("t", stats, rules))
    assert (found["dq_win_coherent"], found["dq_win_coherent_reverse"]) == expected


def test_null_is_neither_in_nor_out(spark):
    df = spark.createDataFrame([(None,), (100,), (5,)], "t int")
    assert violations(check("x", df, [RowRule("r", not_in("t", (100, 200)))])) == {"r": 1}


def test_row_rules_share_one_scan(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    report = check("x", df, [NotEmptyRule(), pk_not_null(("a", "b")), RowRule("neg", F.col("a") < 0)])
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1
    assert violations(report) == {"dq_not_empty": 0, "dq_pk_not_null": 1, "neg": 0}


@pytest.mark.parametrize("layer", ["silver", "gold"])
def test_all_rules_of_a_table_take_at_most_three_scans_of_it(spark, layer):
    layers, length = Layers(spark, "/root/testdata/sf0.001"), "spark.sql.maxMetadataStringLength"
    before = spark.conf.get(length)
    spark.conf.set(length, "2000")
    silver = {t: layers.silver(t) for t in SILVER}
    tables = silver if layer == "silver" else {t: layers.gold(t) for t in GOLD}
    for name, df in tables.items():
        own, references = (silver_rules, silver_references) if layer == "silver" else (gold_rules, gold_references)
        report = check(name, df, own(name) + references(silver).get(name, []))
        plan = report._jdf.queryExecution().executedPlan().toString()
        path = df.inputFiles()[0].rsplit("/", 1)[0]
        scans = sum(path.split("/")[-1] in line for line in plan.splitlines() if "FileScan" in line)
        assert 1 <= scans <= 3, name
    spark.conf.set(length, before)


def test_rules_on_several_key_sets_are_rolled_up_together(spark):
    """Against the same rules one by one, on rows with NULL keys, repeated rows and gaps."""
    rng = random.Random(8)
    data = [(rng.choice("ab") if rng.random() < 0.9 else None, rng.choice([1, 2, None]), rng.randrange(1, 4)) for _ in range(60)]
    df = spark.createDataFrame(data, "m string, p int, i int")
    parents = spark.createDataFrame([("a", 1), ("a", 1), (None, 2)], "m string, p int")
    rules = [
        UniqueRule("unique", ("m", "p", "i")), GroupRule("many", ("m",), "n > 20"), FrameDensityRule("dense", ("m", "p"), "i"),
        DistinctPerGroupRule("two", ("m",), "p", "n <> 2"), DistinctPerGroupRule("three", ("p",), "i", "n <> 3"),
        ForeignKeyRule("fk", ("m", "p"), parents), ForeignKeyRule("fk_m", ("m",), parents.select("m")),
        GroupRule("few", ("p",), "n < 25"),
    ]
    together = violations(check("x", df, rules))
    assert together == {k: v for rule in rules for k, v in violations(check("x", df, [rule])).items()}
    groups = defaultdict(list)
    for m, p, i in data:
        groups[m, p].append(i)
    assert together["unique"] == len(data) - len(set(data))
    assert together["dense"] == sum(min(x) != 1 or max(x) != len(x) for x in groups.values())
    assert together["fk"] == sum(key != ("a", 1) for key in groups)
    assert together["fk_m"] == len({m for m, _ in groups} - {"a"})
    assert together["two"] == sum(len({p for n, p in groups if n == m and p is not None}) != 2 for m in {m for m, _ in groups})


def test_counts_are_observed_while_rows_are_written(spark, tmp_path):
    df, counts = observe_counts(spark.range(10), {"even": F.col("id") % 2 == 0, "none": F.col("id") > 99})
    df.write.parquet(str(tmp_path / "x"))
    assert counts() == {"even": 5, "none": 0}
    same, nothing = observe_counts(df, {})
    assert same is df and nothing() == {}


def test_empty_tables_violate_nothing_but_emptiness(spark):
    df = spark.createDataFrame([], "a int, i int")
    report = check("x", df, [NotEmptyRule(), UniqueRule("u", ("a",)), FrameDensityRule("d", ("a",), "i")])
    assert violations(report) == {"dq_not_empty": 1, "u": 0, "d": 0}


def test_policy(spark):
    df = spark.createDataFrame([], "a int")
    report, lines = check("x", df, [NotEmptyRule()]), []
    assert settle(report, "report", log=lines.append) is report and lines == ["x.dq_not_empty: 1"]
    with pytest.raises(ContractViolation, match="x.dq_not_empty: 1"):
        settle(report, "raise")
    assert settle(report, "raise", tolerated=["dq_not_empty"]) is report
    with pytest.raises(ValueError):
        settle(report, "ignore")
