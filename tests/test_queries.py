"""Every registered query against the SQL that states its result."""

import os

import pytest
from compare import connect, differences, plan
from conftest import DATA, TABLES

import __spark_entry__ as entry_points
from snowloom.queries import QUERIES

FOLDER = f"{DATA}/{os.environ.get('TEST_SF', 'sf0.001')}"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER, TABLES)


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1500


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = entry_points.queries()[name](spark, FOLDER)
    # No join of all pairs and no Python between Spark's own operators.
    text = plan(df)
    for word in ("CartesianProduct", "NestedLoop", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in text
    assert differences(df, con, entry_points.oracle_sql()[name]) == []
