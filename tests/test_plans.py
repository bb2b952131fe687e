"""Physical-plan properties of every registered query (scale guards)."""

import contextlib
import io
import os
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="TESTDATA not present")

# the only non-equi join: a window table whose size is span / window length
RANGE_JOINS = {"window_coverage"}


def _plan(df, mode="formatted"):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cartesian_no_python(spark, name):
    plan = _plan(entry.queries()[name](spark, SF), "extended")
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in RANGE_JOINS:
        assert "BroadcastNestedLoopJoin" not in plan


def test_filters_reach_the_scan(spark):
    for name in ["date_range_filter", "avg_of_avgs_by_year"]:
        plan = _plan(entry.queries()[name](spark, SF))
        assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan or \
            "LessThan(o_orderdate" in plan


def test_columns_are_pruned(spark):
    plan = _plan(entry.queries()["star_region_sum"](spark, SF))
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double>" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_growing_tables_not_hinted(spark):
    """Customer-sized inputs are never broadcast by hint: with automatic
    broadcasting off, the star join must be a sort-merge join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(entry.queries()["star_region_sum"](spark, SF))
        assert "SortMergeJoin" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_landed_snapshots_read_by_one_scan(spark):
    """Both landed extractions come back through ONE multi-path JSON scan
    (no per-file union chain) that reads only the record fields it needs."""
    plan = _plan(entry.queries()["landed_series_recipe"](spark, SF))
    assert len(re.findall(r"^\(\d+\) Scan json", plan, re.M)) == 1 and "Union" not in plan
    assert "ReadSchema: struct<serie:string,codigo:int,data:string,valor:string>" in plan
