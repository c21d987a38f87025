"""Data-quality rules, one query each, and the whole validation reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import functions as F

from matchloom.operators.quality import ContractViolation, RowRule, check, combine, not_in, settle
from matchloom.plans.pipeline import Lakehouse, amend_silver, run_gold, run_silver, validate
from matchloom.plans.validation import (
    gold_references, gold_rules, silver_references, silver_rules, validate_gold, validate_silver,
)
from matchloom.schemas import BRONZE, GOLD, MIN_GAME_SECONDS, SILVER, TEAM_IDS
from matchloom.session import shared_dir, together
from matchloom.sources.landing import load_bronze
from matchloom.sources.tables import read_table, table_path, write_upsert
from matchloom.workloads.inputs import SOURCES, Layers
from matchloom.workloads.lakehouse_sql import over_lakehouse
from matchloom.workloads.registry import query


def _count_groups(table: str, keys: str, having: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {keys} FROM {table} GROUP BY {keys} HAVING {having}))"


def _orphans(child: str, parent: str, keys: str, where: str = "TRUE") -> str:
    return (
        f"(SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {child}"
        f" ANTI JOIN (SELECT {keys} FROM {parent} WHERE {where}) USING ({keys})))"
    )


def _rows(table: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {condition})"


def _base_sql(table: str, contract) -> dict[str, str]:
    keys = ", ".join(contract.key)
    nulls = " OR ".join(f"{k} IS NULL" for k in contract.key)
    return {
        "dq_not_empty": f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table})",
        "dq_pk_not_null": _rows(table, nulls),
        "dq_pk_unique": f"(SELECT count(*) FROM {table})"
        f" - (SELECT count(*) FROM (SELECT DISTINCT {keys} FROM {table}))",
    }


def _joined(condition: str) -> str:
    return (
        "(SELECT count(*) FROM gold_team_stats t JOIN silver_matches m USING (match_id)"
        f" WHERE {condition})"
    )


# Violations by table and rule, as SQL over the lakehouse tables.
RULE_SQL: dict[str, dict[str, str]] = {
    **{f"silver_{t}": _base_sql(f"silver_{t}", c) for t, c in SILVER.items()},
    **{f"gold_{t}": _base_sql(f"gold_{t}", c) for t, c in GOLD.items()},
}
RULE_SQL["silver_matches"]["dq_ts_range"] = _rows(
    "silver_matches",
    "game_creation < TIMESTAMP '2020-01-01' OR game_creation > TIMESTAMP '2030-01-01'",
)
for _table in ("silver_match_teams", "silver_match_participants", "gold_team_stats"):
    RULE_SQL[_table]["dq_team_domain"] = _rows(_table, "team_id NOT IN (100, 200)")
RULE_SQL["silver_match_teams"] |= {
    "dq_silver_two_teams": _count_groups("silver_match_teams", "match_id", "count(*) <> 2"),
    "dq_silver_fk_team_match": _orphans("silver_match_teams", "silver_matches", "match_id"),
}
RULE_SQL["silver_match_participants"] |= {
    "dq_kda_nonneg": _rows("silver_match_participants", "kda < 0"),
    "dq_pid_populated": _rows("silver_match_participants", "participant_id IS NULL"),
    "dq_pid_range": _rows("silver_match_participants", "participant_id < 1 OR participant_id > 10"),
    "dq_silver_ten_participants": _count_groups(
        "silver_match_participants", "match_id", "count(*) <> 10"
    ),
    "dq_silver_fk_participant_match": _orphans(
        "silver_match_participants", "silver_matches", "match_id"
    ),
    "dq_silver_fk_participant_account": _orphans(
        "silver_match_participants", "silver_accounts", "puuid"
    ),
}
for _table, _fk in (
    ("silver_timeline_frames", "dq_silver_fk_frame_match"),
    ("silver_timeline_events", "dq_silver_fk_event_match"),
):
    RULE_SQL[_table] |= {
        "dq_minute_nonneg": _rows(_table, "minute < 0"),
        _fk: _orphans(_table, "silver_matches", "match_id"),
    }
RULE_SQL["gold_team_stats"] |= {
    "dq_no_remake": _rows("gold_team_stats", "game_duration_seconds < 300"),
    "dq_two_teams": _count_groups("gold_team_stats", "match_id", "count(*) <> 2"),
    "dq_fk_team_match": _orphans("gold_team_stats", "silver_matches", "match_id"),
    "dq_win_coherent": _joined("t.team_id = m.winning_team_id AND NOT t.win"),
    "dq_win_coherent_reverse": _joined("t.team_id <> m.winning_team_id AND t.win"),
}
RULE_SQL["gold_player_performance"] |= {
    "dq_rates_nonneg": _rows(
        "gold_player_performance",
        "gold_per_minute < 0 OR damage_per_minute < 0 OR cs_per_minute < 0 OR damage_per_gold < 0",
    ),
    "dq_gold_earned_pos": _rows("gold_player_performance", "gold_earned <= 0"),
    "dq_no_remake": _rows("gold_player_performance", "game_duration_seconds < 300"),
    "dq_player_count": _count_groups(
        "gold_player_performance", "match_id", "count(*) < 1 OR count(*) > 10"
    ),
    "dq_ten_players": _count_groups("gold_player_performance", "match_id", "count(*) <> 10"),
    "dq_fk_player_match": _orphans("gold_player_performance", "silver_matches", "match_id"),
    "dq_fk_player_account": _orphans("gold_player_performance", "silver_accounts", "puuid"),
}
RULE_SQL["gold_draft"] |= {
    "dq_draft_type": _rows("gold_draft", "type NOT IN ('pick', 'ban')"),
    "dq_no_sentinel": _rows("gold_draft", "champion_id = -1"),
    "dq_draft_count": _count_groups("gold_draft", "match_id", "count(*) < 10 OR count(*) > 20"),
}
RULE_SQL["gold_player_frames_indexed"] |= {
    "dq_pid_range": _rows("gold_player_frames_indexed", "participant_id < 1 OR participant_id > 10"),
    "dq_frame_gapless": _count_groups(
        "gold_player_frames_indexed", "match_id, participant_id",
        "min(frame_index) <> 1 OR max(frame_index) <> count(*)",
    ),
    "dq_ten_pids": _count_groups(
        "gold_player_frames_indexed", "match_id", "count(DISTINCT participant_id) <> 10"
    ),
    "dq_fk_frame_participant": _orphans(
        "gold_player_frames_indexed", "silver_match_participants", "match_id, participant_id",
        "participant_id IS NOT NULL",
    ),
}


def _report_lines(tables: Iterable[str], rule: str | None = None) -> list[str]:
    return [
        f"SELECT '{table}' AS table_name, '{name}' AS rule, CAST({sql} AS BIGINT) AS violations"
        for table in tables
        for name, sql in RULE_SQL[table].items()
        if rule is None or name == rule
    ]


def _report_sql(tables: list[str], rule: str | None = None) -> str:
    return over_lakehouse("\nUNION ALL ".join(_report_lines(tables, rule)))


class _Stored:
    """Stored tables by name, built when first looked up."""

    def __init__(self, get):
        self._get = get

    def __getitem__(self, name: str):
        return self._get(name)


def _rules(silver: _Stored, table: str, wanted: str):
    layer, name = table.split("_", 1)
    if layer == "silver":
        own, refs = silver_rules(name), lambda: silver_references(silver)
    else:
        own, refs = gold_rules(name), lambda: gold_references(silver)
    found = [r for r in own if r.name == wanted]
    return found or [r for r in refs().get(name, []) if r.name == wanted]


def _register_rules() -> None:
    by_rule: dict[str, list[str]] = {}
    for table, rules in RULE_SQL.items():
        for rule in rules:
            by_rule.setdefault(rule, []).append(table)

    def one_rule(rule: str, tables: list[str]):
        def build(spark, sf):
            layers = Layers(spark, sf)
            named = [table.split("_", 1) for table in tables]
            layers.share_parse(*[name for _, name in named])
            below = {source for layer, name in named if layer == "gold" for source in SOURCES[name]}
            # A rule scans its table once, so what no gold table is built from is not stored, nor are tables of other rules.
            silver = _Stored(lambda name: layers.silver(name, once=name not in below))
            reports = []
            for table, (layer, name) in zip(tables, named, strict=True):
                df = silver[name] if layer == "silver" else layers.gold(name, once=True)
                reports.append(check(table, df, _rules(silver, table, rule)))
            report = reports[0]
            for other in reports[1:]:
                report = report.unionByName(other)
            return report

        return build

    for rule, tables in by_rule.items():
        query(rule, _report_sql(tables, rule))(one_rule(rule, tables))


_register_rules()


@query("tbl_silver_validation", _report_sql([f"silver_{t}" for t in SILVER]))
def silver_validation(spark, sf):
    layers = Layers(spark, sf)
    layers.share_parse(*SILVER)
    return validate_silver({t: layers.silver(t) for t in SILVER})


@query("tbl_gold_validation", _report_sql([f"gold_{t}" for t in GOLD]))
def gold_validation(spark, sf):
    """All gold rules under the policy that reports and goes on."""
    layers = Layers(spark, sf)
    layers.share_parse(*SILVER)
    silver = {t: layers.silver(t) for t in SILVER}
    return settle(validate_gold({t: layers.gold(t) for t in GOLD}, silver), on_violation="report")


_STORED = "count(*) AS n, count_if(team_id NOT IN (100, 200) OR game_duration_seconds < 300) AS bad"


@query(
    "dq_policy",
    over_lakehouse(
        f"""SELECT * FROM (
            WITH batch AS (
                SELECT * REPLACE (CASE WHEN coalesce(win, FALSE) THEN 300 ELSE team_id END AS team_id,
                                  CASE WHEN coalesce(win, FALSE) THEN game_duration_seconds ELSE 100 END AS game_duration_seconds)
                FROM gold_team_stats WHERE team_id = 100
            ), counted AS (
                SELECT 'dq_pk_not_null' AS rule, count_if(match_id IS NULL OR team_id IS NULL) AS violations FROM batch
                UNION ALL SELECT 'dq_team_domain', count_if(team_id NOT IN (100, 200)) FROM batch
                UNION ALL SELECT 'dq_no_remake', count_if(game_duration_seconds < 300) FROM batch
            ), stored AS (
                SELECT 'raise' AS policy, TRUE AS stopped, {_STORED} FROM gold_team_stats
                UNION ALL
                SELECT 'report', FALSE, {_STORED} FROM (
                    SELECT match_id, team_id, game_duration_seconds FROM batch
                    UNION ALL
                    SELECT match_id, team_id, game_duration_seconds FROM gold_team_stats
                    WHERE team_id <> 100 OR coalesce(win, FALSE))
            )
            SELECT policy, stopped, rule, CAST(violations AS BIGINT) AS violations, n AS stored_rows,
                   CAST(bad AS BIGINT) AS stored_bad_rows
            FROM stored CROSS JOIN counted)"""
    ),
)
def policy(spark, sf):
    """A batch that breaks rules meets a stored table: ``raise`` stops before the table changes, ``report`` goes on.

    Violations are counted while the batch is written, so under either policy it is scanned once.
    """
    contract, root = GOLD["team_stats"], shared_dir(spark, "lake")
    good = Layers(spark, sf).gold("team_stats")
    won = F.coalesce("win", F.lit(False))
    batch = good.filter("team_id = 100").withColumns({
        "team_id": F.when(won, 300).otherwise(F.col("team_id")),
        "game_duration_seconds": F.when(won, F.col("game_duration_seconds")).otherwise(100),
    })
    rules = [r for r in gold_rules("team_stats") if isinstance(r, RowRule)]
    write_upsert(good, contract, root, rules=rules)
    lines = []
    for on_violation in ("raise", "report"):
        stopped = False
        try:
            counts = write_upsert(batch, contract, root, rules=rules, on_violation=on_violation)
        except ContractViolation as violation:
            stopped, counts = True, violation.counts
        bad = not_in("team_id", TEAM_IDS) | (F.col("game_duration_seconds") < MIN_GAME_SECONDS)
        stored = read_table(spark, root, contract).agg(F.count("*").alias("n"), F.count_if(bad).alias("bad")).head()
        lines += [(on_violation, stopped, rule, n, stored.n, stored.bad) for rule, n in counts.items()]
    return spark.createDataFrame(
        lines, "policy string, stopped boolean, rule string, violations long, stored_rows long, stored_bad_rows long"
    )


MEASURES = {
    "team_stats": "baron_kills", "player_performance": "gold_earned", "draft": "draft_order",
    "player_frames_indexed": "total_gold",
}


def _key(table: str) -> str:
    return f"concat_ws('/', {', '.join(GOLD[table].key)})"


@query(
    "pipe_gold",
    over_lakehouse(
        "\nUNION ALL ".join(
            [f"SELECT '{t}' AS table_name, {_key(t)} AS row_key, CAST({m} AS BIGINT) AS measure FROM gold_{t}"
             for t, m in MEASURES.items()]
            + _report_lines(RULE_SQL)
            + [f"SELECT 'bronze_{t}', 'rejected_documents', CAST(0 AS BIGINT)" for t in ("matches", "timelines")]
        )
    ),
)
def pipeline(spark, sf):
    """Bronze to gold through stored tables, amended and validated; the gold step runs twice and changes nothing.

    Rows of the tables by key with a measure, then the report.
    """
    layers, lake = Layers(spark, sf), Lakehouse(spark, shared_dir(spark, "lake"))
    together(spark, *[
        lambda e=entity: load_bronze(layers.bronze(e), table_path(lake.root, BRONZE[e]))
        for entity in ("matches", "timelines", "accounts")
    ])
    rejected = run_silver(lake)
    amend_silver(lake)
    run_gold(lake)
    run_gold(lake)
    gold = lake.gold()
    rows = [
        gold[t].select(F.lit(t).alias("table_name"), F.expr(_key(t)).alias("row_key"), F.col(m).cast("bigint").alias("measure"))
        for t, m in MEASURES.items()
    ]
    report = combine([validate(lake), rejected])
    return combine([*rows, report.toDF("table_name", "row_key", "measure")])
