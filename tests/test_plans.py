"""The physical plans the design relies on."""

import pytest
from pyspark.sql import functions as F

from matchloom.operators.joins import enrich, restrict
from matchloom.operators.keys import latest_by_key, running_index
from matchloom.plans import gold as g
from matchloom.plans import silver as s
from matchloom.sources.landing import documents_of_days, land_json, read_documents
from matchloom.workloads.inputs import Layers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set(adaptive, "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    spark.conf.unset(adaptive)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_row_is_cut_before_and_after_one_shuffle(spark):
    text = plan(latest_by_key(spark.range(10).selectExpr("id % 3 AS k", "id"), ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_a_document_is_parsed_once(layers):
    assert plan(s.parsed_matches(layers.bronze("matches"))).count("from_json") == 1


def test_builders_scan_only_their_nested_columns(layers):
    parsed = layers.parsed("matches")
    assert "participants" not in plan(s.match_teams(parsed)).split("ReadSchema")[1]
    assert "objectives" not in plan(s.match_participants(parsed)).split("ReadSchema")[1]
    slim = plan(s.match_teams(parsed).select("match_id", "win"))
    assert "PushedFilters: [IsNotNull(match_id)" in slim


def test_validity_filter_reaches_the_scan(layers):
    text = plan(layers.build_gold("team_stats"))
    assert "GreaterThanOrEqual(game_duration_seconds,300)" in text


@pytest.mark.parametrize("table", ["team_stats", "player_performance", "draft", "player_frames_indexed"])
def test_no_nested_loop_or_cartesian_joins(layers, no_broadcast, table):
    text = plan(layers.build_gold(table))
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" in text


def test_unique_facts_join_without_a_further_shuffle(layers, no_broadcast):
    text = plan(layers.build_gold("team_stats"))
    assert text.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("how", ["inner", "left", "semi"])
def test_a_hot_key_is_split_over_tasks(spark, no_broadcast, how):
    """A third of the facts share a key and still do not end up in one task."""
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
        )
        names = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("k"), F.lit("n").alias("name"))
        joined = restrict(facts, names, ["k"]) if how == "semi" else enrich(facts, names, ["k"], how)
        assert len(joined.collect()) == 60_000
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_numbering_shuffles_its_rows_once(layers):
    """What follows the numbered ranges moves only one row per range."""
    frames = layers.silver("timeline_frames")
    text = plan(running_index(frames, ["match_id", "participant_id"], ["timestamp_ms"], "n", ties=[]))
    assert text.count("BroadcastExchange") == 1 and "SortMergeJoin" not in text
    ranged = plan(frames.repartitionByRange("match_id", "timestamp_ms").sortWithinPartitions("match_id", "timestamp_ms"))
    assert ranged.count("Exchange") == 1


def leaves(df):
    """The scans of an executed query."""
    executed = df._jdf.queryExecution().executedPlan()
    if executed.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        executed = executed.executedPlan()
    found = executed.collectLeaves()
    out = []
    for i in range(found.size()):
        leaf = found.apply(i)
        if leaf.getClass().getSimpleName().endswith("QueryStageExec"):
            inner = leaf.plan().collectLeaves()
            out += [inner.apply(j) for j in range(inner.size())]
        else:
            out.append(leaf)
    return [x for x in out if x.getClass().getSimpleName() == "FileSourceScanExec"]


def test_days_chosen_by_another_table_prune_folders(spark, tmp_path):
    days = spark.range(30).select(F.col("id").alias("v"), F.expr("date_add(DATE '2024-01-01', CAST(id AS INT))").cast("string").alias("dt"))
    land_json(days, str(tmp_path), "x")
    spark.range(30).selectExpr("id", "date_add(DATE '2024-01-01', CAST(id AS INT)) AS extraction_date").write.parquet(str(tmp_path / "days"))
    chosen = spark.read.parquet(str(tmp_path / "days")).filter("id % 10 = 3")
    found = documents_of_days(read_documents(spark, str(tmp_path), "x", whole_file=False), chosen)
    assert "dynamicpruning" in plan(found).lower()
    assert sorted(str(r.extraction_date) for r in found.collect()) == ["2024-01-04", "2024-01-14", "2024-01-24"]
    assert [x.metrics().apply("numPartitions").value() for x in leaves(found) if x.metrics().contains("numPartitions")] == [3]


@pytest.mark.parametrize("how", ["inner", "semi"])
def test_joins_of_bucketed_tables_move_no_row(layers, no_broadcast, how):
    teams, matches = (layers.bucketed(t, ("match_id",)) for t in ("match_teams", "matches"))
    valid = matches.filter("game_duration_seconds >= 300")
    joined = restrict(teams, valid, ["match_id"]) if how == "semi" else enrich(teams, valid.select("match_id", "winning_team_id"), ["match_id"])
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert "Exchange" not in plan(joined.groupBy("match_id").count())
    plain = restrict(layers.silver("match_teams"), layers.silver("matches").filter("game_duration_seconds >= 300"), ["match_id"])
    assert joined.count() == plain.count() > 0


def test_gold_of_bucketed_silver_has_no_exchange_on_the_fact(layers, no_broadcast):
    teams, matches = (layers.bucketed(t, ("match_id",)) for t in ("match_teams", "matches"))
    assert "Exchange" not in plan(g.team_stats(teams, matches, unique=True))


def test_a_bloom_filter_drops_facts_before_the_shuffle(spark, tmp_path, no_broadcast):
    """Lowered limits stand for large tables; the exact join follows, so the result is that of the join alone."""
    spark.range(200_000).selectExpr("id % 50000 AS k", "id").write.parquet(str(tmp_path / "facts"))
    spark.range(50_000).selectExpr("id AS k", "id % 100 AS part").write.parquet(str(tmp_path / "keys"))
    size, enabled = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", "spark.sql.optimizer.runtime.bloomFilter.enabled"
    shuffled, counts = [], []
    for on in ("true", "false"):
        spark.conf.set(size, "0")
        spark.conf.set(enabled, on)
        try:
            facts, keys = (spark.read.parquet(str(tmp_path / x)) for x in ("facts", "keys"))
            joined = restrict(facts, keys.filter("part = 7"), ["k"])
            assert ("might_contain" in plan(joined)) == (on == "true")
            counts.append(joined.count())
            moved = restrict(facts, keys.filter("part = 7"), ["k"])
            moved.collect()
            text = moved._jdf.queryExecution().executedPlan()
            shuffled.append(_rows_moved(text))
        finally:
            spark.conf.unset(size)
            spark.conf.set(enabled, "true")
    assert counts == [2000, 2000]
    assert shuffled[0] < 0.2 * shuffled[1]


def _rows_moved(executed):
    """Rows written by all shuffles of an executed query."""
    if executed.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        executed = executed.executedPlan()
    total, nodes = 0, [executed]
    while nodes:
        node = nodes.pop()
        name = node.getClass().getSimpleName()
        if name.endswith("QueryStageExec"):
            nodes.append(node.plan())
        if name == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total
