import pytest

from compare import compare, connect
from gridloom.llm.catalog import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], sf_dir)[0] is None
