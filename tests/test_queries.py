"""Every registered query against its DuckDB statement."""

import pytest
from compare import differences, duck

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_a_statement():
    assert set(entry.core_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry.core_queries()))
def test_query(spark, con, name):
    assert differences(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry.entry(spark).columns == ["league_name", "scoring_category", "matches", "share"]
