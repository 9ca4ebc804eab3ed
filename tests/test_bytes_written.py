"""What a report has written for it: the layers it reads, no others, and large tables compressed."""

import glob
import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")


def test_reports_write_only_the_summaries_they_read(spark, scratch):
    from weekly_mart.plans import reports
    from weekly_mart.plans.pipeline import Mart

    m = Mart(spark, SF, scratch)
    done = lambda name: m.ws.is_complete(f"{m.base}/gold/{name}_closed")
    assert reports.r10(m.gold()).count() == 99
    assert done("fact") and not done("sales_daily") and not done("sales_versioned")
    assert reports.r2(m.gold()).count() > 0
    assert done("sales_versioned") and not done("sales_daily")
    m.build()
    assert done("sales_daily")

    home = m.base.replace("file:", "")
    landed = glob.glob(f"{home}/landing/department/v-*/part-*")
    assert landed and all(f.endswith(".csv.gz") for f in landed)
    for table in ("bronze/department_raw", "gold/fact_closed", "gold/sales_daily_closed", "gold/sales_versioned_closed"):
        files = glob.glob(f"{home}/{table}/v-*/part-*")
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert m.bronze("department").count() == 5951
