import pytest
from compare import assert_same, database
from helpers import SMALL

from threadloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries(spark, name):
    df = queries.QUERIES[name](spark, SMALL)
    if name in queries.ORACLE:
        assert_same(df, database(SMALL), queries.ORACLE[name])
    else:
        assert df.count() > 0
