"""Plan checks: pruning and pushdown at the scan, no unpartitioned windows, Python only where stated."""

from conftest import SF_SMALL
from sheetwright.plans import registry as R


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rollup_is_partial_plus_final_and_pruned(spark):
    plan = _plan(R.q_object_rollup(spark, SF_SMALL))
    assert plan.count("HashAggregate") >= 2
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_returnflag:string," \
           "l_linestatus:string>" in plan


def test_python_and_window_nodes(spark):
    """Python runs only in slugify's Unicode fold and in the chunked hash of large files; every Window is partitioned by keys (none over all rows)."""
    import re

    for name, fn in R.QUERIES.items():
        plan = _plan(fn(spark, SF_SMALL))
        python_nodes = bool(re.search(r"EvalPython|MapInPandas|MapInArrow|InPandas", plan))
        assert python_nodes == (name in ("slugify", "hash_files")), name
        for line in plan.splitlines():
            if re.search(r"\bWindow \[", line):
                assert not re.search(r"\bWindow \[.*?\], \[\]", line), (name, line)


def test_pk_filter_reaches_scan_as_pruned_columns(spark):
    plan = _plan(R.q_pk_filter(spark, SF_SMALL))
    assert "FileScan parquet" in plan or "Scan parquet" in plan


def test_row_index_has_no_shuffle(spark):
    plan = _plan(R.q_row_index(spark, SF_SMALL))
    assert "Exchange hashpartitioning" not in plan
    assert "BroadcastHashJoin" in plan
