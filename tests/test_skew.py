"""A hot join key: one (store, dept) holding most of the sales rows. With
broadcasting off and AQE skew handling forced on, the point-in-time fact
build splits the hot partition and still gives the broadcast result."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _summary(df):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum("store_weekly_sales").alias("s")).first()
    return r.n, r.s


def test_hot_key_fact_build(spark):
    from weekly_mart.operators import fact
    from weekly_mart.plans.pipeline import mart

    m = mart(spark, SF)
    dept = m.stg_department()
    hot = dept.where("store_id = 1 and dept_id = 1")
    # the hot key gets 300 extra copies of its rows: most of the input
    skewed = dept.unionByName(hot.select("*", F.explode(F.array_repeat(F.lit(1), 300)).alias("_c")).drop("_c"))
    args = (m.store_dim(), m.stg_fact(), m.date_dim())
    expected = _summary(fact.build_fact(skewed, *args, as_of="2000-01-01 00:00:00"))

    old = {k: spark.conf.get(k, None) for k in SKEW}
    try:
        for k, v in SKEW.items():
            spark.conf.set(k, v)
        f = fact.build_fact(skewed.repartition(16), *args, as_of="2000-01-01 00:00:00")
        got = _summary(f)
        f.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            f.explain()
        plan = buf.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert got == expected
    base_n, base_s = _summary(m.fact())
    hot_n, hot_s = _summary(fact.build_fact(hot, *args, as_of="2000-01-01 00:00:00"))
    assert got == (base_n + 300 * hot_n, base_s + 300 * hot_s)
    assert "SortMergeJoin" in plan and "skew=true" in plan
