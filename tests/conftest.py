import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark):
    from tidemark.session import new_folder
    from tidemark.tables.store import TableStore
    return TableStore(spark, new_folder(spark, "test-store"))


@pytest.fixture
def folder(spark):
    from tidemark.session import new_folder
    return lambda label="f": new_folder(spark, label)


def rows(df):
    """Rows as a sorted list of tuples, for comparing as multisets."""
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def rows_of():
    return rows
