import pytest

from oracle import rows_of_spark, rows_of_sql, views
from tracewright.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(name, spark, sf):
    assert rows_of_spark(QUERIES[name](spark, sf)) == rows_of_sql(views(sf), ORACLE_SQL[name])
