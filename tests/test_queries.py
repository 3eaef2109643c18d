"""Every catalogue query against its SQL twin on the smallest tables."""

from __future__ import annotations

import os

import pytest
from check_oracle import compare, connect

from __spark_entry__ import entry, oracle_sql, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "cer" in df.columns


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    sql = oracle_sql().get(name)
    if sql is None:
        assert queries()[name](spark, SF).count() > 0
    else:
        ok, note = compare(spark, con, SF, queries()[name], sql)
        assert ok, note


def test_no_query_moves_a_table_into_one_task(spark):
    """Plans of the order operators: one-partition exchanges carry counts only."""
    for name in ("assign_shards", "interleave_splits", "seeded_shuffle", "attach_positional", "concat_text"):
        plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString().split("\n")
        for i, line in enumerate(plan):
            if "SinglePartition" in line:
                assert "HashAggregate" in plan[i + 1], (name, plan[i + 1])
