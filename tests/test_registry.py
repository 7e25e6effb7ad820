import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SF
from pitchgrain.registry.oracle import STATEMENTS
from pitchgrain.registry.spark_queries import QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    if name in STATEMENTS:
        assert compare(df, duck, STATEMENTS[name]) is None
    else:
        assert df.count() > 0


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(QUERIES) <= set(entry.queries()) and set(STATEMENTS) <= set(entry.oracle_sql())


def test_entry(spark):
    assert entry.entry(spark).columns[:2] == ["match_id", "player_id"]
