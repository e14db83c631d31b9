"""Every query with an oracle: Spark vs DuckDB on the smallest test tables."""
import pytest

from __spark_entry__ import oracle_sql, queries
from carestat.plans.check import compare, duckdb_conn
from conftest import SF_SMALL

# fits the whole suite of six models: too long for a test; its figures are tested in test_ranks.py
LONG = {"t3_t8_e1_prediction_checks"}
ORACLES = {k: v for k, v in oracle_sql().items() if k not in LONG}


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF_SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(queries()[name](spark, SF_SMALL), con, ORACLES[name])
    assert ok, msg


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["age", "readmission_rate_30d", "count"]
    assert df.count() > 0
