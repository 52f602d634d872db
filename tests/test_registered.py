"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import connect, differences

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no fixture tables")


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_a_twin():
    assert set(entry.REGISTRY) == set(entry.ORACLES)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(entry.REGISTRY))
def test_query_equals_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    assert differences(df, db, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["doc_id", "query_id", "rank", "score", "snippet"]
