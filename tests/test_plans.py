"""Plan guards for every registered query: no all-pairs joins, no row-at-a-time
Python UDFs, and column pruning at the scan of the flagship query."""

import os
import re

import pytest

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_no_all_pairs_and_no_row_udfs(spark):
    import __spark_entry__ as e
    bad = {}
    for name, fn in e.queries().items():
        plan = _plan(fn(spark, SF))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")
                if op in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")
def test_flagship_prunes_columns(spark):
    import __spark_entry__ as e
    df = e.queries()["holdout_split"](spark, SF)
    schemas = re.findall(r"lineitem\.parquet\].*?ReadSchema: (struct<[^>]*>)", _plan(df))
    assert schemas and all(s == "struct<l_orderkey:bigint,l_partkey:bigint>" for s in schemas)
