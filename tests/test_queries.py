import pytest

from compare import compare, connect
from gridloom.plans.catalog import QUERIES
from gridloom.plans.oracles import ORACLES as TABLE_ORACLES
from gridloom.plans.tree_queries import TREE_ORACLES

ORACLES = {**TABLE_ORACLES, **TREE_ORACLES}

MODEL_QUERIES = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_twin_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, sf_dir, name):
    problem, _, _ = compare(spark, duck, name, QUERIES[name], ORACLES[name], sf_dir)
    assert problem is None


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_model_query_runs(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    assert len(set(df.columns)) == len(df.columns)
    assert df.count() > 0
