import pytest

from roadmetrics.queries import ORACLE_SQL, QUERIES
from tests.oracle import SF, check


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    check(spark, QUERIES[name], ORACLE_SQL[name])


@pytest.mark.parametrize("name", ["metrics_takeover", "metrics_roi", "metrics_weaving", "all_events"])
def test_program_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
