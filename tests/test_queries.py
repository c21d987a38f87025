"""Every registered query against its SQL, over whole tables."""

import pytest
from compare import connect, differences

from __spark_entry__ import entry, queries
from matchloom.workloads import ORACLES, QUERIES
from matchloom.workloads.inputs import Layers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(SF) as open_connection:
        yield open_connection


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    problems = differences(spark, connection, SF, name, QUERIES[name], ORACLES[name])
    # Rare rows may be absent from the smallest tables.
    assert [p for p in problems if not p.endswith("no rows")] == []


def test_all_are_registered():
    assert QUERIES.items() <= queries().items()


def test_entry(spark):
    assert entry(spark).count() > 0


def test_a_created_namespace_holds_a_whole_table(spark):
    """every row of a table that grows, not 25 nations."""
    assert QUERIES["sink_create_ns"](spark, SF).count() == Layers(spark, SF).silver("match_teams").count() > 1000


def test_a_table_read_by_name_is_whole(spark):
    """no row is left out by a filter."""
    assert QUERIES["src_table"](spark, SF).count() == Layers(spark, SF).silver("match_teams").count() > 1000
