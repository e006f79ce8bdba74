"""Every query against its SQL; SF chooses the scale of the test tables."""

import os

import pytest

import __spark_entry__ as entry
from check import compare, connect
from conftest import sf
from edgeflow.queries import QUERIES

SCALE = os.environ.get("SF", "0.001")


@pytest.fixture(scope="module")
def connection():
    return connect(sf(SCALE))


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, connection, name):
    df = entry.queries()[name](spark, sf(SCALE))
    assert compare(df, connection, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["id", "n"]
