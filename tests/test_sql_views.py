"""Report SQL over the registered views equals the DataFrame reports."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_sql_report_over_views(spark):
    from weekly_mart.plans import reports
    from weekly_mart.plans.pipeline import mart

    m = mart(spark, SF)
    assert "wm_fact" in m.register_views("wm_")
    sql = spark.sql("""
        SELECT s.store_type AS type, f.store_id AS store, SUM(f.store_weekly_sales) AS weekly_sales
        FROM wm_fact f
        JOIN wm_date_dim d ON f.date_id = d.date_id
        JOIN wm_store_dim s ON f.store_id = s.store_id AND f.dept_id = s.dept_id
             AND d.store_date BETWEEN s.vrsn_start_date AND COALESCE(s.vrsn_end_date, TIMESTAMP_NTZ '9999-12-31 00:00:00')
        GROUP BY 1, 2""")
    got = {(r.type, r.store): r.weekly_sales for r in sql.collect()}
    want = {(r.type, r.store): r.weekly_sales for r in reports.r6_store(m.gold()).collect()}
    assert got == want
