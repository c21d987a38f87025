"""Sources, sinks and merges."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchloom.operators import upsert as u
from matchloom.plans import silver as s
from matchloom.plans.ingest import record_outcomes, to_fetch
from matchloom.schemas import SILVER, TableContract
from matchloom.session import path_exists, shared_dir, stage
from matchloom.sources import landing as l
from matchloom.sources.tables import create_namespace, create_table, read_table, write_upsert
from matchloom.workloads.inputs import Layers
from matchloom.workloads.lakehouse_sql import over_lakehouse
from matchloom.workloads.registry import query

EVENT_DAYS = "SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS extraction_date FROM events"


def _event_days(spark, sf):
    return Layers(spark, sf).table("events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("dt")
    )


@query(
    "src_wholetext",
    """SELECT concat('S', s_suppkey) AS puuid, s_name AS game_name, DATE '2001-01-01' AS extraction_date
       FROM supplier""",
)
def whole_files(spark, sf):
    """One file per account document, each read as one row."""
    base = shared_dir(spark, "landing")
    suppliers = Layers(spark, sf).table("supplier")
    files = suppliers.select(
        # Pretty-printed, so that a document spans lines and only a whole-file read gets it back.
        F.to_json(
            F.struct(F.concat(F.lit("S"), "s_suppkey").alias("puuid"), F.col("s_name").alias("gameName")),
            {"pretty": "true"},
        ).alias("value"),
        F.lit("2001-01-01").alias("dt"),
        F.col("s_suppkey").alias("account"),
    )
    files.write.partitionBy("dt", "account").option("compression", "none").text(f"{base}/accounts")
    rows = l.read_documents(spark, base, "accounts", glob="*.txt")
    return rows.select(
        F.get_json_object("raw_json", "$.puuid").alias("puuid"),
        F.get_json_object("raw_json", "$.gameName").alias("game_name"), "extraction_date",
    )


@query(
    "src_dt_partition",
    EVENT_DAYS + """ WHERE CAST(ts AS DATE) IN (
        SELECT DATE '2024-01-01' + CAST(n_nationkey AS INTEGER) FROM nation WHERE n_regionkey = 1)""",
)
def chosen_days(spark, sf):
    """The landed days that another table chooses; the other days' folders are not read."""
    base = shared_dir(spark, "landing")
    l.land_json(_event_days(spark, sf), base, "events")
    chosen = Layers(spark, sf).table("nation").filter("n_regionkey = 1").select(
        F.expr("date_add(DATE '2024-01-01', CAST(n_nationkey AS INT))").alias("extraction_date")
    )
    raw = l.documents_of_days(l.read_documents(spark, base, "events", whole_file=False), chosen)
    document = F.from_json("raw_json", "event_id BIGINT, user_id BIGINT, event_type STRING")
    return raw.select(document.alias("d"), "extraction_date").select("d.*", "extraction_date")


@query("land_json", EVENT_DAYS)
def landed_days(spark, sf):
    """Documents landed by day come back with their day as the extraction date."""
    base = shared_dir(spark, "landing")
    l.land_json(_event_days(spark, sf), base, "events")
    raw = l.read_documents(spark, base, "events", whole_file=False)
    document = F.from_json("raw_json", "event_id BIGINT, user_id BIGINT, event_type STRING")
    return raw.select(document.alias("d"), "extraction_date").select("d.*", "extraction_date")


@query("src_ingest_date", "SELECT event_id, DATE '2026-03-26' AS extraction_date FROM events")
def ingest_date(spark, sf):
    return l.with_ingest_date(Layers(spark, sf).table("events").select("event_id"), "2026-03-26")


@query("src_readback", "SELECT event_id, user_id, event_type FROM events")
def readback(spark, sf):
    """A landed day read back, together with a day that never landed."""
    base = shared_dir(spark, "landing")
    schema = T.StructType(
        [T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
         T.StructField("event_type", T.StringType())]
    )
    day = _event_days(spark, sf).withColumn("dt", F.lit("2026-03-26"))
    l.land_json(day, base, "events")
    there = l.read_day(spark, base, "events", "2026-03-26", schema, multi_line=False)
    absent = l.read_day(spark, base, "events", "2026-03-27", schema, multi_line=False)
    return there.unionByName(absent)


@query(
    "src_roster",
    """SELECT concat('T', s_nationkey) AS team, 'support' AS role, s_name AS game_name, 'TAG' AS tag_line
       FROM supplier""",
)
def roster(spark, sf):
    path = shared_dir(spark, "roster")
    Layers(spark, sf).table("supplier").select(
        F.concat(F.lit("T"), "s_nationkey").alias("team"), F.lit("support").alias("role"),
        F.col("s_name").alias("game_name"), F.lit("TAG").alias("tag_line"),
    ).write.json(path)
    return l.read_roster(spark, path, multi_line=False)


@query(
    "src_subquery_cte",
    """WITH big AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_totalprice >= 50000)
       SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM (SELECT * FROM big) x
       GROUP BY o_custkey""",
)
def sql_with_views(spark, sf):
    """A named view queried through a CTE and a derived table."""
    Layers(spark, sf).table("orders").createOrReplaceTempView("matchloom_orders")
    return spark.sql(
        """WITH big AS (
               SELECT o_orderkey, o_custkey, o_totalprice FROM matchloom_orders WHERE o_totalprice >= 50000)
           SELECT o_custkey, count(*) AS n, max(o_totalprice) AS top FROM (SELECT * FROM big) x
           GROUP BY o_custkey"""
    )


@query(
    "src_temp_view",
    "SELECT o_orderpriority, count(*) AS n, min(o_orderdate) AS first_date FROM orders GROUP BY o_orderpriority",
)
def temp_view(spark, sf):
    """A registered view, queried by name."""
    Layers(spark, sf).table("orders").createOrReplaceTempView("matchloom_order_view")
    return spark.sql(
        "SELECT o_orderpriority, count(*) AS n, min(o_orderdate) AS first_date FROM matchloom_order_view GROUP BY o_orderpriority"
    )


@query(
    "limit_probe",
    """SELECT name, n > 0 AS has_rows FROM (
           SELECT 'late_lines' AS name, count(*) AS n FROM (SELECT 1 FROM lineitem WHERE l_shipdate >= DATE '1995-01-01' LIMIT 1)
           UNION ALL SELECT 'unknown_parts', count(*) FROM (SELECT 1 FROM lineitem WHERE l_partkey < 0 LIMIT 1))""",
)
def limit_probe(spark, sf):
    """Whether any row meets a condition; one row per probe is enough to know."""
    lines = Layers(spark, sf).table("lineitem")
    probes = {"late_lines": "l_shipdate >= DATE '1995-01-01'", "unknown_parts": "l_partkey < 0"}
    found = None
    for name, condition in probes.items():
        one = lines.filter(condition).limit(1).agg((F.count("*") > 0).alias("has_rows")).select(F.lit(name).alias("name"), "has_rows")
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "doc_metadata",
    """SELECT event_id, '2026-03-26' AS execution_date, 'events_api' AS source, TRUE AS is_stamped, 0 AS days_old
       FROM events""",
)
def doc_metadata(spark, sf):
    """The stamp is a full time with zone, of today."""
    events = Layers(spark, sf).table("events").select("event_id")
    stamped = l.with_lineage(events, "2026-03-26", "events_api")
    meta = "_extraction_metadata"
    return stamped.select(
        "event_id", f"{meta}.execution_date", f"{meta}.source",
        F.col(f"{meta}.extracted_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}(Z|[+-]\d\d:\d\d)$").alias("is_stamped"),
        F.datediff(F.current_date(), F.to_date(f"{meta}.extracted_at")).alias("days_old"),
    )


@query(
    "sink_append",
    "SELECT props AS raw_json, CAST(ts AS DATE) AS extraction_date FROM events",
)
def sink_append(spark, sf):
    """Days loaded one after the other; the first of them twice."""
    path = shared_dir(spark, "bronze")
    docs = Layers(spark, sf).table("events").select(
        F.col("props").alias("raw_json"), F.col("ts").cast("date").alias("extraction_date")
    )
    early = F.dayofmonth("extraction_date") <= 15
    for part in (docs.filter(early), docs.filter(~early), docs.filter(early)):
        l.load_bronze(part, path)
    return l.read_bronze(spark, path)


CATALOG_SQL = over_lakehouse(
    """SELECT match_id, team_id, win, baron_kills, array_to_string(bans, ',') AS bans, extraction_date
       FROM silver_match_teams"""
)

CATALOG_COLUMNS = ["match_id", "team_id", "win", "baron_kills", "bans", "extraction_date"]


@query("sink_create_table", CATALOG_SQL)
def catalog_table(spark, sf):
    """A catalog table created twice, filled once and read by name."""
    location = shared_dir(spark, "database")
    database = f"matchloom_{location.rsplit('-', 1)[1]}"
    contract = SILVER["match_teams"]
    for _ in range(2):
        create_table(spark, database, contract, location)
    rows = contract.conform(Layers(spark, sf).silver("match_teams"))
    rows.write.insertInto(f"{database}.{contract.name}", overwrite=True)
    stored = spark.read.table(f"{database}.{contract.name}")
    return stored.select(*CATALOG_COLUMNS)


@query("sink_create_ns", CATALOG_SQL)
def namespace(spark, sf):
    """A namespace created twice holds the table that is stored in it, at the place it was given."""
    location = shared_dir(spark, "database")
    database = f"matchloom_{location.rsplit('-', 1)[1]}"
    for _ in range(2):
        create_namespace(spark, database, location)
    Layers(spark, sf).silver("match_teams").write.saveAsTable(f"{database}.match_teams")
    if not (spark.catalog.databaseExists(database) and path_exists(spark, f"{location}/match_teams")):
        raise ValueError(f"{database} is not at {location}")
    return spark.read.table(f"{database}.match_teams").select(*CATALOG_COLUMNS)


@query("src_table", CATALOG_SQL)
def table_by_name(spark, sf):
    """A table read by its name, which the session's current namespace completes."""
    name = f"matchloom_match_teams_{shared_dir(spark, 'x').rsplit('-', 1)[1]}"
    teams = Layers(spark, sf).silver("match_teams").select(*CATALOG_COLUMNS)
    teams.write.option("path", shared_dir(spark, "table")).saveAsTable(name)
    return spark.table(name)


# Target and source are two overlapping parts of orders: by status F, P and O, P.
TARGET_SQL = "t AS (SELECT * FROM orders WHERE o_orderstatus <> 'O')"
SOURCE_SQL = (
    "s AS (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) FROM orders WHERE o_orderstatus <> 'F')"
)
UPSERTED_SQL = (
    f"WITH {TARGET_SQL}, {SOURCE_SQL} SELECT t.* FROM t ANTI JOIN s USING (o_orderkey)"
    " UNION ALL SELECT * FROM s"
)


def _sides(spark, sf):
    orders = Layers(spark, sf).table("orders")
    source = orders.filter("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", F.col("o_totalprice") + F.lit(1.0)
    )
    return orders.filter("o_orderstatus <> 'O'"), source


@query("merge_upsert_star", UPSERTED_SQL)
def upsert_all(spark, sf):
    target, source = _sides(spark, sf)
    return u.upsert(target, source, ["o_orderkey"])


@query(
    "join_merge",
    """WITH s AS (SELECT l_orderkey AS o_orderkey, CAST(max(l_partkey) AS BIGINT) AS number FROM lineitem
                  WHERE l_linenumber > 3 GROUP BY l_orderkey)
       SELECT coalesce(o.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(s.number, o.o_custkey) AS number
       FROM (SELECT * FROM orders WHERE o_totalprice > 50000) o FULL JOIN s ON o.o_orderkey = s.o_orderkey""",
)
def merge_join(spark, sf):
    """Target rows the source lacks stay, others take its value, and source rows the target lacks are added."""
    layers = Layers(spark, sf)
    source = layers.table("lineitem").filter("l_linenumber > 3").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max("l_partkey").cast("bigint").alias("number")
    )
    target = layers.table("orders").filter("o_totalprice > 50000").select("o_orderkey", F.col("o_custkey").cast("bigint").alias("number"))
    return u.upsert(target, source, ["o_orderkey"])


@query("sink_upsert_stored", UPSERTED_SQL)
def upsert_stored(spark, sf):
    """The same through a stored table; the second upsert is run twice."""
    target, source = _sides(spark, sf)
    contract = TableContract("silver", "orders", target.schema, ("o_orderkey",))
    root = shared_dir(spark, "lake")
    for rows in (target, source, source):
        write_upsert(rows, contract, root)
    return read_table(spark, root, contract)


@query(
    "merge_upsert_explicit",
    f"""WITH {TARGET_SQL}, {SOURCE_SQL}
        SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, t.o_custkey, t.o_orderstatus,
               CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END
                   AS o_totalprice,
               t.o_orderdate, t.o_orderpriority
        FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""",
)
def upsert_listed(spark, sf):
    target, source = _sides(spark, sf)
    return u.upsert_columns(target, source, ["o_orderkey"], ["o_totalprice"])


LINES_SQL = "s AS (SELECT l_orderkey, count(*) AS n_lines FROM lineitem GROUP BY l_orderkey)"


def _line_counts(spark, sf):
    lines = Layers(spark, sf).table("lineitem")
    return lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_lines"))


@query(
    "merge_update_only",
    f"""WITH {LINES_SQL} SELECT o.o_orderkey, o.o_orderstatus,
            CASE WHEN s.l_orderkey IS NOT NULL THEN s.n_lines ELSE -1 END AS n_lines
        FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey""",
)
def update_only(spark, sf):
    target = Layers(spark, sf).table("orders").select(
        "o_orderkey", "o_orderstatus", F.lit(-1).cast("bigint").alias("n_lines")
    )
    return u.update_only(target, _line_counts(spark, sf), ["o_orderkey"], ["n_lines"])


@query(
    "merge_update_if_null",
    f"""WITH {LINES_SQL} SELECT o.o_orderkey,
            CASE WHEN o.o_orderstatus = 'P' THEN s.n_lines ELSE 0 END AS n_lines
        FROM orders o LEFT JOIN s ON o.o_orderkey = s.l_orderkey""",
)
def backfill(spark, sf):
    target = Layers(spark, sf).table("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.lit(0).cast("bigint")).alias("n_lines")
    )
    return u.backfill_nulls(target, _line_counts(spark, sf), ["o_orderkey"], ["n_lines"])


@query(
    "alter_add_column",
    "SELECT o_orderkey, o_totalprice, CAST(NULL AS INT) AS participant_id FROM orders",
)
def add_column(spark, sf):
    orders = Layers(spark, sf).table("orders").select("o_orderkey", "o_totalprice")
    return u.add_column(u.add_column(orders, "participant_id", "int"), "o_totalprice", "string")


@query(
    "merge_replace_group",
    f"""WITH {TARGET_SQL}, {SOURCE_SQL}
        SELECT t.* FROM t ANTI JOIN s USING (o_custkey) UNION ALL SELECT * FROM s""",
)
def replace_group(spark, sf):
    target, source = _sides(spark, sf)
    return u.replace_group(target, source, ["o_custkey"])


@query(
    "skip_existing",
    """SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
)
def skip_existing(spark, sf):
    layers = Layers(spark, sf)
    ids = layers.table("orders").select(F.col("o_orderkey").alias("match_id"))
    landed = layers.table("lineitem").select(F.col("l_orderkey").alias("match_id"))
    return to_fetch(ids, landed).select(F.col("match_id").alias("o_orderkey"))


@query(
    "agg_outcome_counts",
    """SELECT CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')
                       THEN 'skipped'
                   WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 'success'
                   ELSE 'failed' END AS status, count(*) AS n
       FROM orders GROUP BY 1""",
)
def outcomes(spark, sf):
    """Counted while the ids are written by status."""
    layers = Layers(spark, sf)
    ids = layers.table("orders").select(F.col("o_orderkey").alias("match_id"))
    lines = layers.table("lineitem").select(F.col("l_orderkey").alias("match_id"), "l_linestatus")
    counts = record_outcomes(ids, lines.filter("l_linestatus = 'F'"), lines, shared_dir(spark, "outcomes"))
    return spark.createDataFrame([(status, n) for status, n in counts.items() if n], "status string, n long")


REJECTED = {
    2: ("concat('{\"metadata\": {\"matchId\": \"M', l_orderkey)", "malformed JSON"),
    3: ("concat('{\"info\": {\"mapId\": ', l_partkey, '}}')", "no matchId"),
    4: ("'  '", "empty document"),
    5: ("CAST(NULL AS STRING)", "empty document"),
}
READABLE = """concat('{"metadata": {"matchId": "M', l_orderkey, '-', l_linenumber, '"}}')"""
_CASES = " ".join(f"WHEN {n} THEN {text}" for n, (text, _) in REJECTED.items())
RAW = f"CASE l_linenumber {_CASES} ELSE {READABLE} END"


@query(
    "land_rejects",
    f"""SELECT CASE WHEN l_linenumber NOT IN (2, 3, 4, 5) THEN concat('M', l_orderkey, '-', l_linenumber) END AS match_id,
               CASE WHEN l_linenumber IN (2, 3, 4, 5) THEN {RAW.replace("STRING", "VARCHAR")} END AS raw_json,
               CASE l_linenumber WHEN 2 THEN 'malformed JSON' WHEN 3 THEN 'no matchId'
                   WHEN 4 THEN 'empty document' WHEN 5 THEN 'empty document' END AS reason,
               CAST(date_trunc('month', l_shipdate) AS DATE) AS extraction_date
        FROM lineitem""",
)
def rejects(spark, sf):
    """Documents of which some cannot be read: those that can and the rejects table are together what came in.

    The first load brings unreadable documents only; the second, of everything, replaces what it left.
    """
    documents = Layers(spark, sf).table("lineitem").select(
        F.expr(RAW).alias("raw_json"), F.expr("CAST(date_trunc('month', l_shipdate) AS DATE)").alias("extraction_date")
    )
    path, parsed = shared_dir(spark, "rejects"), stage(s.parsed_matches(documents), "parsed")
    broken = s.parsed_matches(documents.withColumn("raw_json", F.lit("{")))
    l.load_rejects(s.rejects(broken), path)
    l.load_rejects(s.rejects(parsed), path)
    read = parsed.filter(F.col("match_id").isNotNull()).select(
        "match_id", F.lit(None).cast("string").alias("raw_json"), F.lit(None).cast("string").alias("reason"), "extraction_date"
    )
    kept = l.read_rejects(spark, path)
    return read.unionByName(kept.withColumn("match_id", F.lit(None).cast("string")).select(*read.columns))
