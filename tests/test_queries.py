"""Every registered query at the smallest scale, beside its SQL."""

import pytest

import __spark_entry__ as entry_point
from hirelens.catalog import all_queries
from tests.compare import check, database

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", all_queries.QUERIES)
def test_query_equals_sql(spark, con, name):
    result, _ = check(spark, con, name, FOLDER)
    assert result.startswith("ok"), result


def test_every_query_has_sql():
    assert set(all_queries.QUERIES) == set(all_queries.ORACLES)
    assert set(all_queries.QUERIES) <= set(entry_point.queries())
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["skill_a", "skill_b", "co_occurrence_count"]
