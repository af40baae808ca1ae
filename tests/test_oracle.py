"""Every core query against its SQL, on the smallest tables."""

import pytest
from compare import assert_same, database
from helpers import SMALL

import __spark_entry__  # noqa: F401 - registers all queries
from threadloom.plans import core


@pytest.fixture(scope="module")
def con():
    return database(SMALL)


@pytest.mark.parametrize("name", sorted(core.ORACLE))
def test_matches_sql(spark, con, name):
    assert_same(core.QUERIES[name](spark, SMALL), con, core.ORACLE[name])


@pytest.mark.parametrize("name", sorted(set(core.QUERIES) - set(core.ORACLE)))
def test_runs(spark, name):
    """Queries that SQL does not state give rows; what they are is tested beside their operators."""
    assert core.QUERIES[name](spark, SMALL).count() > 0
