"""What the stored layers of the queries, and a job of many statements, leave on disk."""

import os

import pytest
from pyspark.sql import functions as F

from matchloom.schemas import GOLD
from matchloom.session import tune
from matchloom.sources.tables import read_table, write_upsert
from matchloom.workloads import inputs
from matchloom.workloads.inputs import Layers

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shared(tmp_path, monkeypatch):
    monkeypatch.setattr(inputs, "_STORED", {})
    monkeypatch.setattr(inputs, "shared_dir", lambda spark, name: f"{tmp_path}/{name}")
    return tmp_path


def test_documents_are_not_stored(spark, shared):
    """their text was most of what the queries wrote."""
    Layers(spark, SF).silver("match_teams")
    assert sorted(os.listdir(shared)) == ["layer-parsed-matches", "layer-silver-match_teams"]


def test_shuffle_files_go_with_their_statement(spark, tmp_path):
    """and a DataFrame that is run again makes them anew."""
    def left() -> int:
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return sum(blocks.apply(i).getName().startswith("shuffle_") for i in range(blocks.size()))

    tune(spark)
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before = left()
    rows = sorted(df.collect())
    df.write.parquet(str(tmp_path / "out"))
    assert left() <= before
    assert sorted(df.collect()) == rows and df.count() == 7


def test_a_first_upsert_stages_nothing(spark, tmp_path, monkeypatch):
    """rows were written twice where there was no table to meet."""
    contract = GOLD["team_stats"]
    monkeypatch.setattr("matchloom.sources.tables.stage", lambda *_: pytest.fail("staged"))
    rows = contract.conform(spark.createDataFrame([("A", 100)], "match_id string, team_id int"))
    assert write_upsert(rows, contract, str(tmp_path)) == {}
    assert [(r.match_id, r.team_id) for r in read_table(spark, str(tmp_path), contract).collect()] == [("A", 100)]


def test_large_tables_are_read_as_they_lie(spark):
    """A table with a task for every core is not shuffled to use them."""
    from matchloom.workloads.documents import spread

    cores = spark.sparkContext.defaultParallelism
    many, few = spark.range(0, 100, 1, cores), spark.range(0, 100, 1, 1)
    assert spread(many) is many
    assert spread(few).rdd.getNumPartitions() == cores


def test_one_row_group_gives_documents_to_many_tasks(spark, tmp_path):
    """F7 to F26: a file counted as read by enough tasks, its row groups were fewer, and the orders were broadcast."""
    from matchloom.workloads.documents import match_documents

    lines, orders = 200_000, 1_000
    spark.range(orders).selectExpr(
        "id AS o_orderkey", "id % 90 AS o_custkey", "id * 7.5D AS o_totalprice", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus",
        "DATE '2024-01-01' AS o_orderdate",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(0, lines, 1, 1).selectExpr(
        f"xxhash64(id) % {orders} AS key", "id % 7 + 1 AS l_linenumber", "pmod(xxhash64(id, 1), 200000) AS l_partkey",
        "pmod(xxhash64(id, 2), 10000) AS l_suppkey", "id % 50 + 0.5D AS l_quantity", "rand(1) * 90000 AS l_extendedprice",
        "date_add(DATE '2024-01-01', CAST(id % 900 AS INT)) AS l_shipdate",
    ).selectExpr("abs(key) AS l_orderkey", "* EXCEPT (key)").write.parquet(str(tmp_path / "lineitem.parquet"))
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")  # so that the small file has a split for every core, as a large one has
    try:
        sizes = match_documents(tune(spark), str(tmp_path)).groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.max(F.length("raw_json"))
        ).collect()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert sum(r.n for r in sizes) == lines
    assert len(sizes) >= 4 and max(r.n for r in sizes) < lines / 2


def test_a_filter_on_parsed_values_leaves_documents_alone(spark):
    """below the text Spark took minutes to plan such a filter, and wrote each document once more for it."""
    from matchloom.plans.silver import participant_ids_latest

    documents = Layers(tune(spark), SF).bronze("matches")
    plan = participant_ids_latest(documents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 1
    assert plan.count("get_json_object") == 2  # nor is a path read again
    assert documents.filter("raw_json IS NULL").isEmpty()


def test_latest_participant_ids_of_odd_documents(spark):
    from matchloom.plans.silver import participant_ids_latest

    def document(players: str, match: str = '"A"') -> str:
        return f'{{"metadata":{{"matchId":{match}}},"info":{{"participants":{players}}}}}'

    rows = [
        (document('[{"puuid":"p","participantId":1},{"puuid":"p","participantId":2},{"puuid":"q"}]'), "2024-01-01"),
        (document('[{"puuid":"q","participantId":7},{"participantId":9},null]'), "2024-01-02"),
        (document("[]"), "2024-01-03"), (document("null"), "2024-01-03"), ("broken", "2024-01-03"), (None, "2024-01-03"),
        (document('[{"puuid":"r","participantId":3}]', "null"), "2024-01-03"),
        (document('[{"puuid":"p","participantId":null}]', '"B"'), None),
    ]
    bronze = spark.createDataFrame(rows, "raw_json string, day string").selectExpr("raw_json", "CAST(day AS DATE) AS extraction_date")
    found = participant_ids_latest(bronze)
    assert found.columns == ["match_id", "puuid", "participant_id"]
    assert sorted(found.collect(), key=str) == [("A", "p", 2), ("A", "q", 7), ("B", "p", None)]


def test_documents_read_once_are_parsed_on_the_way(spark, shared, rows):
    """F8 to F24: all fields of all documents were parsed and written, however few tables a query built from them."""
    from matchloom.workloads import QUERIES

    for name in ("dq_kda_nonneg", "fn_round", "proj_nested"):
        assert QUERIES[name](spark, SF).count() > 0
        assert not os.path.exists(shared) or os.listdir(shared) == []
    for name in ("dq_fk_team_match", "dq_player_count", "rpt_champion_pool"):
        assert QUERIES[name](spark, SF).count() > 0
        assert {"layer-parsed-matches", "layer-silver-match_participants", "layer-silver-match_teams"}.isdisjoint(os.listdir(shared))
    plan = QUERIES["dq_kda_nonneg"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("JsonToStructs") + plan.count("from_json(") == plan.count("StructsToJsonEvaluator") == 1
    QUERIES["dq_no_remake"](spark, SF).count()  # builds three tables, so the parse is stored
    assert "layer-parsed-matches" in os.listdir(shared)


@pytest.mark.parametrize("table", ["matches", "match_teams", "match_participants"])
def test_tables_from_their_own_fields(spark, rows, table):
    """Parsing the fields of one table gives what parsing all of them gives, of odd documents as well."""
    from matchloom.plans import silver as s

    teams = '[{"teamId":100,"win":false,"objectives":{"baron":{"kills":"x"},"tower":{"kills":3}},"bans":[{"championId":7}]},{"teamId":200,"win":true}]'
    players = '[{"puuid":"p","kills":"many","deaths":1},{"puuid":"q","kills":2},null]'

    def document(match: str, teams: str = teams, players: str = players, head: str = '"gameDuration":400,"mapId":11') -> str:
        return f'{{"metadata":{{"matchId":{match}}},"info":{{{head},"teams":{teams},"participants":{players}}}}}'

    texts = [
        document('"A"'), document('"B"', teams="null"), document('"C"', players='"none"'), document('"D"', head='"gameDuration":"long"'),
        document("null"), document('"E"')[:-30], '{"metadata":{"matchId":"F"}}', '{"metadata":{"matchId":"G"},"info":7}', "broken", "", None,
        document('"H"', teams="[]", players="[]"), document("5"),
    ]
    bronze = spark.createDataFrame([(x,) for x in texts], "raw_json string").selectExpr("raw_json", "DATE '2024-01-01' AS extraction_date")
    build = getattr(s, table)
    assert rows(build(s.parsed_for(bronze, table))) == rows(build(s.parsed_matches(bronze))) != []
