"""Every registered query equals its SQL counterpart on the smallest tables."""

import os

import pytest

from oracle import compare, connect
from tidemark.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLES:
        assert compare(spark, con, name, QUERIES[name], ORACLES[name], FOLDER, allow_empty=True) is None
    else:
        assert QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
