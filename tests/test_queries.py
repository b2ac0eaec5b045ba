import pytest

import __spark_entry__ as spark_entry
from tests.compare import difference, duck

SF = "/root/testdata/sf0.001"
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    if name in ORACLES:
        assert difference(spark, con, name, SF) == ""
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_every_sql_has_its_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert spark_entry.entry(spark).count() == 983
