"""Plan audit: no registered query may plan a cartesian product, a nested-loop
join, or Python evaluation; report scans must prune columns."""

import contextlib
import io
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def _names():
    import __spark_entry__ as E

    return sorted(E.queries())


@pytest.mark.parametrize("name", _names())
def test_no_cartesian_or_python(spark, name):
    import __spark_entry__ as E

    plan = _plan(E.queries()[name](spark, SF))
    assert not [f for f in FORBIDDEN if f in plan], plan


def test_report_scan_reads_only_used_columns(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["r10"](spark, SF))
    assert "ReadSchema: struct<dept_id:int,store_weekly_sales:decimal(14,2)>" in plan


def test_staging_filter_pushed_to_scan(spark):
    import __spark_entry__ as E

    plan = _plan(E.queries()["stg_department"](spark, SF))
    assert "PushedFilters: [IsNotNull(weekly_sales)]" in plan
