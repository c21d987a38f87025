"""Raw match, timeline and account documents derived from the relational tables.

Every line item becomes one landed document of the match its order stands for,
every event one landed timeline of a match, every supplier and every customer one
account file; some players have no account. Nothing is grouped on the way: a document is a row.

The column formulas are SQL text that Spark and DuckDB read alike, so that the
checks start from the same inputs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: formulas of the derived inputs ----------------------------
EPOCH_MS = 1_704_067_200_000

MATCH_COLUMNS = {
    "match_id": "concat('M', o_orderkey)",
    "extraction_date": "CAST(date_trunc('month', l_shipdate) AS DATE)",
    "duration": "CAST(floor(o_totalprice * 0.006) AS INT)",
    "version": "o_orderpriority",
    "queue": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 420 ELSE 440 END",
    "win_100": "o_orderstatus = 'F'",
    "win_200": "o_orderstatus = 'O'",
    "line": "l_linenumber",
    "part": "CAST(l_partkey AS INT)",
    "supp": "CAST(l_suppkey AS INT)",
    "cust": "CAST(o_custkey AS INT)",
    "qty": "CAST(floor(l_quantity) AS INT)",
    "price": "CAST(floor(l_extendedprice) AS INT)",
}
# ban list of a team: NULL on line 6, empty on line 7
BANS_100 = ("1 + (part * 3 + line) % 250", "-1", "1 + (supp * 7) % 250", "1 + (part * 3 + line) % 250")
BANS_200 = ("1 + (part * 5) % 250", "1 + (supp * 11 + 1) % 250")
TEAM_100 = {
    "baron": "line", "dragon": "line % 4", "tower": "part % 12", "inhibitor": "supp % 4",
    "riftHerald": "part % 3",
}
TEAM_200 = {
    "baron": "line % 3", "dragon": "part % 5", "tower": "(part + 5) % 12", "inhibitor": "supp % 3",
    "riftHerald": "qty % 3",
}
_COMMON = {
    "wardsPlaced": "qty % 13", "wardsKilled": "part % 7", "totalDamageTaken": "price % 31000",
    "totalHeal": "price % 9000", "item0": "part % 97", "item1": "part % 89", "item2": "supp % 83",
    "item3": "supp % 79", "item4": "qty", "item5": "line", "item6": "0", "summoner1Id": "4",
    "summoner2Id": "line % 15",
}
PLAYER_100 = {
    "participantId": "line", "puuid": "concat('S', supp)", "teamId": "100",
    "championName": "concat('Champion', 1 + part % 200)", "championId": "1 + part % 200",
    "individualPosition": "concat('P', line % 5)", "role": "concat('R', qty % 4)",
    "kills": "qty % 15", "deaths": "CASE WHEN line = 5 THEN NULL ELSE qty % 9 END",
    "assists": "part % 20", "goldEarned": "CASE WHEN qty = 1 THEN 0 ELSE price END",
    "totalMinionsKilled": "part % 301", "neutralMinionsKilled": "supp % 101", "visionScore": "qty",
    "totalDamageDealtToChampions": "price % 45000", **_COMMON, "win": "win_100",
}
PLAYER_200 = {
    "participantId": "8 + cust % 3", "puuid": "concat(CASE WHEN cust % 11 = 3 THEN 'X' ELSE 'C' END, cust)", "teamId": "200",
    "championName": "concat('Champion', 1 + (part + supp) % 200, CASE WHEN line = 1 THEN '*' ELSE '' END)",
    "championId": "1 + (part + supp) % 200",
    "individualPosition": "concat('P', part % 5)", "role": "concat('R', line % 4)",
    "kills": "part % 17", "deaths": "part % 8", "assists": "qty % 23",
    "goldEarned": "price % 17000", "totalMinionsKilled": "qty * 5", "neutralMinionsKilled": "part % 53",
    "visionScore": "line", "totalDamageDealtToChampions": "price % 39000", **_COMMON, "win": "win_200",
}

TIMELINE_COLUMNS = {
    "match_id": "concat('M', user_id * 101)",
    "eid": "CAST(event_id AS INT)",
    "amount": "CAST(floor(value) AS INT)",
    "kind": "event_type",
}
# the two participants of a frame: id and formulas
FRAME_FIELDS = {
    "currentGold": "amount", "totalGold": "amount * 3", "xp": "eid % 18000", "level": "1 + eid % 18",
    "minionsKilled": "eid % 200", "jungleMinionsKilled": "eid % 60",
}
FRAME_IDS = ("1 + eid % 5", "6 + eid % 5")
EVENT_FIELDS = {
    "type": "upper(kind)", "killerId": "1 + eid % 10", "victimId": "1 + (eid + 5) % 10",
    "itemId": "eid % 3000", "wardType": "CASE WHEN kind = 'view' THEN 'YELLOW_TRINKET' END",
    "buildingType": "CASE WHEN kind = 'error' THEN 'TOWER_BUILDING' END",
}
POSITION = {"x": "eid % 14000", "y": "(eid * 7) % 14000"}
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores where a table comes as one small file; a table that is read by enough tasks is not shuffled."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _documents(rows: DataFrame, document: Column) -> DataFrame:
    """``(raw_json, extraction_date)``: each text is written once, whatever its readers ask of it.

    A row number, which Spark takes for nondeterministic, is always there. It keeps a reader's filter on parsed values above
    the text. Below it, each document would be written once for the filter and once more for the row, and planning would take
    minutes: Spark doubles what it infers from such a filter with every column that has a new name here.
    """
    written = F.when(F.monotonically_increasing_id() >= 0, document)
    return rows.select(written.alias("raw_json"), "extraction_date")


def _struct(fields: dict[str, str]):
    return F.struct(*[F.expr(text).alias(name) for name, text in fields.items()])


def _team(team_id: int, win: str, objectives: dict[str, str], bans: tuple[str, ...]):
    ban_list = F.array(
        *[F.struct(F.expr(b).alias("championId"), F.lit(i).alias("pickTurn")) for i, b in enumerate(bans, 1)]
    )
    empty = F.slice(ban_list, 1, 0)
    return F.struct(
        F.lit(team_id).alias("teamId"),
        F.col(win).alias("win"),
        F.struct(
            *[F.struct(F.expr(text).alias("kills")).alias(name) for name, text in objectives.items()]
        ).alias("objectives"),
        F.when(F.col("line") == 7, empty).when(F.col("line") != 6, ban_list).alias("bans"),
    )


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One match document per line item.

    A document costs many times what its rows do, so the join deals the rows out, however few row groups the tables have. Where
    the orders are broadcast, the rows stay in the tasks that read a row group, and the other cores have none.
    """
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    # What is cut off a value is not shuffled.
    of_item = [F.expr(text).alias(name) for name, text in MATCH_COLUMNS.items() if "l_" in text]
    of_order = [F.expr(text).alias(name) for name, text in MATCH_COLUMNS.items() if "l_" not in text]
    base = items.select("l_orderkey", *of_item).join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        *[i for i in MATCH_COLUMNS if "l_" in MATCH_COLUMNS[i]], *of_order,
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("created"),
    )
    info = F.struct(
        F.col("created").alias("gameCreation"),
        F.col("duration").alias("gameDuration"),
        (F.col("created") + F.col("duration") * 1000).alias("gameEndTimestamp"),
        F.col("version").alias("gameVersion"),
        F.lit("CLASSIC").alias("gameMode"),
        F.lit("MATCHED_GAME").alias("gameType"),
        F.lit(11).alias("mapId"),
        F.col("queue").alias("queueId"),
        F.lit("P1").alias("platformId"),
        F.array(
            _team(100, "win_100", TEAM_100, BANS_100), _team(200, "win_200", TEAM_200, BANS_200)
        ).alias("teams"),
        F.array(_struct(PLAYER_100), _struct(PLAYER_200)).alias("participants"),
    )
    metadata = F.struct(F.lit("2").alias("dataVersion"), F.col("match_id").alias("matchId"))
    document = F.to_json(F.struct(metadata.alias("metadata"), info.alias("info")))
    return _documents(base, document)


def timeline_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One timeline document, with one frame of two players and two events, per event row."""
    base = spread(table(spark, sf_dir, "events")).select(
        *[F.expr(text).alias(name) for name, text in TIMELINE_COLUMNS.items()],
        F.date_add(F.col("ts").cast("date"), (F.col("event_id") % 3).cast("int")).alias("extraction_date"),
        (F.unix_millis(F.date_trunc("hour", "ts").cast("timestamp")) - EPOCH_MS).alias("at"),
    )
    position = _struct(POSITION).alias("position")
    entries = []
    for participant in FRAME_IDS:
        entries += [
            F.expr(f"CAST({participant} AS STRING)"),
            F.struct(
                F.expr(participant).alias("participantId"),
                *[F.expr(text).alias(name) for name, text in FRAME_FIELDS.items()],
                position,
            ),
        ]
    event = [F.expr(text).alias(name) for name, text in EVENT_FIELDS.items()]
    helpers = F.array(F.expr("1 + (eid + 1) % 10"), F.expr("1 + (eid + 2) % 10")).alias(
        "assistingParticipantIds"
    )
    frame = F.struct(
        F.col("at").alias("timestamp"),
        F.create_map(*entries).alias("participantFrames"),
        F.array(
            F.struct(F.col("at").alias("timestamp"), *event, helpers, position),
            F.struct((F.col("at") + F.expr("eid % 60000")).alias("timestamp"), *event, helpers, position),
        ).alias("events"),
    )
    document = F.to_json(
        F.struct(
            F.struct(F.col("match_id").alias("matchId")).alias("metadata"),
            F.struct(F.array(frame).alias("frames")).alias("info"),
        )
    )
    return _documents(base, document)


def account_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as arrays of roster records, customers in credit as single API objects."""
    records = table(spark, sf_dir, "supplier").select(
        F.to_json(
            F.array(
                F.struct(
                    F.concat(F.lit("T"), "s_nationkey").alias("team"),
                    F.lit("support").alias("role"),
                    F.col("s_name").alias("game_name"),
                    F.lit("TAG").alias("tag_line"),
                    F.concat(F.lit("S"), "s_suppkey").alias("puuid"),
                    F.upper("s_name").alias("game_name_api"),
                    F.lit("TAG").alias("tag_line_api"),
                )
            )
        ).alias("raw_json")
    )
    objects = table(spark, sf_dir, "customer").select(
        F.to_json(
            F.struct(
                F.concat(F.lit("C"), "c_custkey").alias("puuid"),
                F.col("c_name").alias("gameName"),
                F.lit("CUS").alias("tagLine"),
                (F.col("c_custkey") % 500).alias("summonerLevel"),
                (F.col("c_custkey") % 30).alias("profileIconId"),
            )
        ).alias("raw_json")
    )
    return records.unionByName(objects).withColumn("extraction_date", F.lit("2001-01-01").cast("date"))
