"""Every registered query against its SQL on the smallest tables."""

import pytest

from isobar.plans import registry
from tests.oracle import connect, rows


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, data, name):
    got = registry.queries()[name](spark, data).toPandas()
    want = connect(data).sql(registry.oracle_sql()[name]).df()
    assert rows(got) == rows(want)


def test_interval_join_is_no_nested_loop(spark, data):
    plan = registry.queries()["interval_join_by_key"](spark, data)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
