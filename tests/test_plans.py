"""Physical-plan guards: no cartesian / nested-loop joins, pruned scans."""
import re

import pytest

from __spark_entry__ import oracle_sql, queries
from conftest import SF_SMALL

SQL_QUERIES = sorted(oracle_sql())


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", SQL_QUERIES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(queries()["p5_rate_by_age"](spark, SF_SMALL))
    # lineitem is not needed for the age rate: the outer join on a unique key is removed
    assert "lineitem" not in plan
    # only the needed columns are read
    for schema in re.findall(r"ReadSchema: struct<([^>]*)>", plan):
        assert "o_totalprice" not in schema and "c_acctbal" not in schema and "c_name" not in schema
