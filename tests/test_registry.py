"""Every registered query against its SQL, on the smallest supplied tables."""

import pytest

import __spark_entry__ as entry
from daytally.plans import oracle, registry
from tools.check_queries import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, FOLDER, name, oracle.oracle_sql()[name]) == ""


def test_entry_gives_rows(spark):
    assert entry.entry(spark).columns == ["loghour", "ct"]
    assert entry.entry(spark).count() > 0
