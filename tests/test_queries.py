"""Every query with SQL gives the rows of its SQL."""

import pytest
from compare import DATA, assert_same

from sensorloom import plans

SQL = plans.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert_same(spark, plans.queries()[name], SQL[name])


@pytest.mark.parametrize("name", sorted(set(plans.queries()) - set(SQL)))
def test_other_queries_run(spark, name):
    assert plans.queries()[name](spark, DATA).count() >= 0
