import random
from collections import defaultdict

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from matchloom.operators.keys import (
    _count_runs, duplicate_keys, latest_by_key, moving_mean, numbered_ranges, running_index, top_n_by_key,
)

quick = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def test_latest_by_key_does_not_depend_on_input_order(spark, rows):
    data = [("k", d, v) for d in (1, 2, 2, None) for v in ("a", "b", None)] + [("j", None, None)]
    results = set()
    for seed in range(4):
        shuffled = data[:]
        random.Random(seed).shuffle(shuffled)
        df = spark.createDataFrame(shuffled, "key string, d int, v string").repartition(3)
        results.add(tuple(rows(latest_by_key(df, ["key"], ["d"]))))
    assert results == {(("j", None, None), ("k", 2, "b"))}


def test_top_n_and_duplicates(spark, rows):
    df = spark.createDataFrame([(k, v) for k in "ab" for v in range(5)] + [("c", 1)], "k string, v int")
    top = top_n_by_key(df, ["k"], [F.desc("v")], 2, rank="place")
    assert rows(top) == [("a", 3, 2), ("a", 4, 1), ("b", 3, 2), ("b", 4, 1), ("c", 1, 1)]
    assert rows(duplicate_keys(df, ["k"])) == [("a", 5), ("b", 5)]


@pytest.mark.parametrize("n", [5000, 20_000])
def test_many_first_rows_of_a_hot_key_are_cut_in_parts(spark, n):
    """Two thirds of 30,000 rows share a key; n lies above what Spark cuts before the shuffle by itself."""
    df = spark.range(30_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.expr("CAST(id % 7 AS STRING)")).alias("k"), "id")
    top = top_n_by_key(df, ["k"], [F.desc("id")], n, rank="place", parts=16)
    text = top._jdf.queryExecution().executedPlan().toString()
    assert text.count("Window [row_number()") == 2 and "_salt" in text
    plain = df.withColumn("place", F.row_number().over(Window.partitionBy("k").orderBy(F.desc("id")))).filter(F.col("place") <= n)
    assert {tuple(r) for r in top.collect()} == {tuple(r) for r in plain.collect()}
    salted = df.withColumn("part", F.pmod(F.xxhash64("k", "id"), F.lit(16))).groupBy("k", "part").count()
    assert salted.agg(F.max("count")).first()[0] < 2 * 20_000 / 16


@pytest.fixture
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield 16
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


@quick
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-50, 50))), max_size=80))
def test_running_index_matches_brute_force(spark, many_ranges, data):
    """Ranges hold a few rows each here; keys and order may be NULL, and rows may be repeated."""
    df = spark.createDataFrame(data, "k string, t int")
    groups = defaultdict(list)
    for k, t in data:
        groups[k].append(t)
    first = lambda t: (t is not None, t or 0)  # noqa: E731 - NULL first
    expected = sorted(((k, t, i) for k, ts in groups.items() for i, t in enumerate(sorted(ts, key=first), 1)), key=repr)
    assert sorted((tuple(r) for r in running_index(df, ["k"], ["t"], "i").collect()), key=repr) == expected


def test_running_index_of_several_keys_and_descending_order(spark, rows, many_ranges):
    df = spark.range(500).select((F.col("id") % 2).alias("a"), F.expr("CAST(id % 3 AS STRING)").alias("b"), "id")
    out = running_index(df, ["a", "b"], [F.desc("id")], "n", ties=[])
    plain = df.withColumn("n", F.row_number().over(Window.partitionBy("a", "b").orderBy(F.desc("id"))))
    assert rows(out) == rows(plain)
    assert running_index(df.limit(0), ["a", "b"], ["id"], "n").columns == ["a", "b", "id", "n"]


def test_runs_are_counted_across_batches():
    names, numbers = ["x", "x", None, None, "y", "y", "y", "y"], [1, 1, 1, 1, 1, None, None, 2]
    for cuts in ([], [0, 1], [3, 3, 5], [1, 2, 3, 4, 5, 6, 7]):
        keys = pa.StructArray.from_arrays([pa.array(names), pa.array(numbers)], ["a", "b"])
        batches = [keys.slice(a, b - a) for a, b in zip([0, *cuts], [*cuts, 8])]
        assert [n for out in _count_runs(iter(batches)) for n in out.to_pylist()] == [1, 2, 1, 2, 1, 1, 2, 1]


@quick
@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 7), st.integers(7, 11))
def test_moving_mean_matches_brute_force_at_chunk_borders(spark, values, size, chunk):
    data = [(k, i, float(v)) for k in "ab" for i, v in enumerate(values, 1)]
    df = spark.createDataFrame(data, "k string, i bigint, v double")
    out = moving_mean(df, ["k"], "i", F.col("v"), size, "m", chunk=chunk)
    got = {(r.k, r.i): r.m for r in out.collect()}
    assert len(got) == len(data)
    for k, i, _ in data:
        last = values[max(0, i - size):i]
        assert abs(got[(k, i)] - sum(last) / len(last)) < 1e-9


@pytest.mark.parametrize("order", [["at", "id"], ["at"]])
def test_a_third_of_all_rows_at_one_instant_of_one_key_is_dealt_out(spark, many_ranges, order):
    df = spark.range(48_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 701).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11).alias("at"), "id",
    )
    sizes = [r["count"] for r in numbered_ranges(df, ["k"], order).groupBy("_part").count().collect()]
    assert max(sizes) <= 2 * 48_000 / many_ranges
    hot = [r.i for r in running_index(df, ["k"], order, "i").filter("k = 'hot'").orderBy("id").collect()]
    assert sorted(hot) == list(range(1, 16_001))
