"""The large-scale join path: with broadcasting off, the fact build and the
point-in-time summary plan sort-merge joins (AQE skew splitting on) and
still give the FIXTURES.md figures."""

import contextlib
import io
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
KEYS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.skewJoin.enabled")


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k, None) for k in KEYS}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_fact_and_summary_on_sort_merge_joins(spark, no_broadcast):
    from weekly_mart.operators import fact
    from weekly_mart.plans import summaries
    from weekly_mart.plans.pipeline import mart

    m = mart(spark, SF)
    f = fact.build_fact(m.stg_department(), m.store_dim(), m.stg_fact(), m.date_dim(), as_of="2000-01-01 00:00:00")
    plan = _plan(f)
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    row = f.agg(F.count(F.lit(1)).alias("n"), F.sum("store_weekly_sales").alias("s")).first()
    assert (row.n, row.s) == (5419, Decimal("98736163.89"))

    v = summaries.sales_versioned(m.fact(), m.date_dim(), m.store_dim())
    assert "SortMergeJoin" in _plan(v)
    # the reports' point-in-time re-join (closed on both ends) of the closed fact
    assert v.agg(F.sum("weekly_sales")).first()[0] == Decimal("98847578.97")
