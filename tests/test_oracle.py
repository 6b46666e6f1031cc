"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01); queries without an oracle
must at least run."""

import pytest

from conftest import SMALL
from harness import compare, duck
from logsift.plans.catalog import load_all

REG = load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("key", sorted(REG))
def test_query_matches_oracle(spark, con, key):
    q = REG[key]
    if q.sql is None:
        assert q.build(spark, SMALL).count() >= 0
        return
    df = q.build(spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # no row-at-a-time Python anywhere (pandas folds are Arrow-batched), no
    # cross products
    assert "BatchEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    r = compare(spark, con, lambda *_: df, q.sql, SMALL)
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["hash_match"], r
