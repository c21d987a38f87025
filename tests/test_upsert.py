import datetime as dt

import pytest

from matchloom.operators import upsert as u
from matchloom.operators.quality import ContractViolation, RowRule
from matchloom.schemas import SILVER, TableContract
from matchloom.sources.tables import create_table, read_table, write_all, write_replace, write_upsert
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = "k int, a string, b string"


@pytest.fixture
def sides(spark):
    target = spark.createDataFrame([(1, "a1", "b1"), (2, "a2", None), (None, "x", "y")], SCHEMA)
    source = spark.createDataFrame([(2, "A2", "B2"), (3, "A3", "B3")], SCHEMA)
    return target, source


def test_upsert(sides, rows):
    assert rows(u.upsert(*sides, ["k"])) == [
        (1, "a1", "b1"), (2, "A2", "B2"), (3, "A3", "B3"), (None, "x", "y")]


def test_upsert_columns_leaves_others_and_inserts_null(sides, rows):
    assert rows(u.upsert_columns(*sides, ["k"], ["a"])) == [
        (1, "a1", "b1"), (2, "A2", None), (3, "A3", None), (None, "x", "y")]


def test_update_only_never_inserts_and_may_set_null(spark, sides, rows):
    source = spark.createDataFrame([(1, None), (9, "z")], "k int, a string")
    assert rows(u.update_only(sides[0], source, ["k"], ["a"])) == [
        (1, None, "b1"), (2, "a2", None), (None, "x", "y")]


def test_backfill_touches_only_nulls(sides, rows):
    assert rows(u.backfill_nulls(*sides, ["k"], ["a", "b"])) == [
        (1, "a1", "b1"), (2, "a2", "B2"), (None, "x", "y")]


def test_replace_group_drops_rows_the_group_lost(spark, rows):
    target = spark.createDataFrame([("g", 1), ("g", 2), ("h", 1)], "g string, i int")
    source = spark.createDataFrame([("g", 1)], "g string, i int")
    assert rows(u.replace_group(target, source, ["g"])) == [("g", 1), ("h", 1)]


def test_upsert_newest_ignores_arrival_order(spark, rows):
    old = spark.createDataFrame([(1, "old", 1)], "k int, v string, extraction_date int")
    new = spark.createDataFrame([(1, "new", 2)], "k int, v string, extraction_date int")
    assert rows(u.upsert_newest(old, new, ["k"])) == rows(u.upsert_newest(new, old, ["k"])) == [(1, "new", 2)]


def test_add_column_and_new_rows(sides, rows):
    target, source = sides
    assert u.add_column(target, "a", "int") is target
    assert u.add_column(target, "n", "int").schema["n"].dataType == T.IntegerType()
    assert rows(u.new_rows(source, target, ["k"]), "k") == [(3,)]


CONTRACT = TableContract(
    "silver", "t", T.StructType([T.StructField("k", T.StringType()), T.StructField("i", T.IntegerType()),
                                 T.StructField("v", T.StringType())]), ("k", "i"))


def _rows(spark, data):
    return spark.createDataFrame(data, CONTRACT.schema)


def test_stored_upsert_is_idempotent_and_keeps_the_rest(spark, tmp_path, rows):
    root = str(tmp_path)
    assert read_table(spark, root, CONTRACT).count() == 0
    write_upsert(_rows(spark, [(f"k{n}", 1, "one") for n in range(20)]), CONTRACT, root)
    change = _rows(spark, [("k3", 1, "two"), ("k3", 2, "new"), ("other", 1, "new")])
    for _ in range(2):
        write_upsert(change, CONTRACT, root)
        stored = read_table(spark, root, CONTRACT)
        assert stored.count() == 22
        assert rows(stored.filter("v <> 'one'")) == [("k3", 1, "two"), ("k3", 2, "new"), ("other", 1, "new")]


DATED = TableContract("silver", "d", T.StructType([*CONTRACT.schema.fields, T.StructField("extraction_date", T.DateType())]), ("k", "i"))


def _day(spark, day, v="one", keys=range(2000)):
    date = dt.date(2026, 3, day)
    return spark.createDataFrame([(f"{day}-{n}", 1, v, date) for n in keys], DATED.schema)


def _files(folder):
    return {f: f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def _of_day(files, day):
    return {f for f in files if f"extraction_date=2026-03-{day}" in str(f)}


def test_an_upsert_of_a_few_keys_of_one_day_leaves_other_days_alone(spark, tmp_path):
    """0.1 % of one day's keys; the folder's name needs escaping in a URI."""
    root = str(tmp_path / "a lake 100%")
    for day in (10, 11, 12):
        write_upsert(_day(spark, day), DATED, root)
    before = _files(tmp_path)
    write_upsert(_day(spark, 11, "two", (5, 77)), DATED, root)
    after = _files(tmp_path)
    assert _of_day(before, 10) | _of_day(before, 12) <= after.keys()
    assert all(before[f] == after[f] for f in before.keys() & after.keys())
    assert not _of_day(before, 11) & after.keys()
    stored = read_table(spark, root, DATED)
    assert stored.count() == 6000 and stored.filter("v = 'two'").count() == 2


def test_new_keys_touch_no_file(spark, tmp_path):
    root = str(tmp_path)
    write_upsert(_day(spark, 10), DATED, root)
    before = _files(tmp_path)
    write_upsert(_day(spark, 11), DATED, root)
    assert before.items() <= _files(tmp_path).items()
    assert read_table(spark, root, DATED).count() == 4000


def test_a_key_moves_to_the_day_of_its_latest_extraction(spark, tmp_path, rows):
    root = str(tmp_path)
    write_upsert(_day(spark, 10, keys=range(3)), DATED, root)
    moved = _day(spark, 10, "moved", (1,)).withColumn("extraction_date", F.lit("2026-03-12").cast("date"))
    older = _day(spark, 10, "older", (2,)).withColumn("extraction_date", F.lit("2026-03-01").cast("date"))
    write_upsert(moved.unionByName(older), DATED, root, newest_wins=True)
    assert rows(read_table(spark, root, DATED), "k", "v") == [("10-0", "one"), ("10-1", "moved"), ("10-2", "one")]
    assert rows(read_table(spark, root, DATED).filter("extraction_date > '2026-03-10'"), "k") == [("10-1",)]


def test_an_upsert_repeated_after_a_crash_leaves_one_row_per_key(spark, tmp_path, rows):
    """The driver dies between writing the new files and deleting the old ones."""
    root, change = str(tmp_path), _day(spark, 10, "two", (3,))
    write_upsert(_day(spark, 10, keys=range(9)), DATED, root)
    old = {f: f.read_bytes() for f in _files(tmp_path)}
    write_upsert(change, DATED, root)
    for f, content in old.items():
        f.write_bytes(content)
    assert read_table(spark, root, DATED).count() == 18
    for newest in (False, True):
        write_upsert(change, DATED, root, newest_wins=newest)
        stored = read_table(spark, root, DATED)
        assert stored.count() == 9 and rows(stored.filter("v = 'two'"), "k") == [("10-3",)]


@pytest.mark.parametrize("contract", [CONTRACT, DATED], ids=lambda c: c.name)
def test_a_violation_stops_an_upsert_before_the_table_changes(spark, tmp_path, contract):
    root, rules = str(tmp_path), [RowRule("odd", F.col("i") == 2), RowRule("absent", F.col("v").isNull())]
    one = spark.createDataFrame([("a", 1, "x", dt.date(2026, 3, 1))], DATED.schema).select(*contract.columns)
    assert write_upsert(one, contract, root, rules=rules) == {"odd": 0, "absent": 0}
    before = _files(tmp_path)
    bad = one.withColumn("i", F.lit(2)).unionByName(one.withColumn("v", F.lit("y")))
    with pytest.raises(ContractViolation, match=f"silver_{contract.name}.odd: 1") as raised:
        write_upsert(bad, contract, root, rules=rules)
    assert raised.value.counts == {"odd": 1, "absent": 0} and _files(tmp_path) == before
    assert write_upsert(bad, contract, root, rules=rules, on_violation="report") == {"odd": 1, "absent": 0}
    assert read_table(spark, root, contract).count() == 2
    with pytest.raises(ValueError):
        write_upsert(bad, contract, root, rules=rules, on_violation="ignore")


def test_stored_group_replacement(spark, tmp_path, rows):
    root = str(tmp_path)
    write_upsert(_rows(spark, [("k", 1, "a"), ("k", 2, "a"), ("j", 1, "a")]), CONTRACT, root)
    write_upsert(_rows(spark, [("k", 1, "b")]), CONTRACT, root, group=("k",))
    assert rows(read_table(spark, root, CONTRACT)) == [("j", 1, "a"), ("k", 1, "b")]


def test_conform_casts_orders_and_fills(spark):
    df = spark.createDataFrame([("7", "k")], "i string, k string")
    assert CONTRACT.conform(df).first().asDict() == {"k": "k", "i": 7, "v": None}


def test_catalog_tables_are_created_once(spark):
    for _ in range(2):
        create_table(spark, "loom_silver", SILVER["match_teams"])
    table = spark.read.table("loom_silver.match_teams")
    assert table.columns == SILVER["match_teams"].columns
    assert table.filter(F.col("match_id").isNotNull()).count() == 0


def test_a_full_write_replaces_all_files(spark, tmp_path, rows):
    root = str(tmp_path / "a lake")
    write_all(_day(spark, 10, keys=range(3)), DATED, root)
    before = _files(tmp_path)
    write_all(_day(spark, 11, keys=range(2)), DATED, root)
    assert not before.keys() & _files(tmp_path).keys()
    assert rows(read_table(spark, root, DATED), "k") == [("11-0",), ("11-1",)]


def test_replacing_removes_keys_without_rows(spark, tmp_path, rows):
    root = str(tmp_path)
    write_upsert(_rows(spark, [("a", 1, "x"), ("b", 1, "x"), ("c", 1, "x")]), CONTRACT, root)
    scope = spark.createDataFrame([("a",), ("b",), ("new",)], "k string")
    write_replace(_rows(spark, [("b", 2, "y"), ("new", 1, "z")]), scope, CONTRACT, root)
    assert rows(read_table(spark, root, CONTRACT), "k") == [("b",), ("c",), ("new",)]
