"""Every registered query against its SQL in DuckDB, at the smallest scale."""

import os

import pytest
from compare import DATA, compare, connect

from catalog.registry import CASES
from tidemark.session import release

SF_DIR = f"{DATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", CASES)
def test_query_matches_its_sql(spark, con, name):
    _, _, problem = compare(spark, con, CASES[name], SF_DIR)
    release()
    assert problem is None, problem


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.entry(spark).columns) == len(CASES[entry.FLAGSHIP].columns)
