import pytest

from oracle import rows_of_spark, rows_of_sql, views
from tracewright.plans.queries import ORACLE_SQL, QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return views(sf)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(name, spark, sf, con):
    assert rows_of_spark(QUERIES[name](spark, sf)) == rows_of_sql(con, ORACLE_SQL[name])


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
