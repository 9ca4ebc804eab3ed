"""Row order of the ordered reports and data sets, read from the collected sequence."""

import os

import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")

# keys in order; a leading minus sorts that key descending
ORDER = {
    "r1_store": "store is_holiday", "r2": "year bucket_ord", "r3": "size store", "r4": "month type", "r5": "year",
    "r6_type": "type", "r6_store": "type -weekly_sales store", "r7_year": "year", "r7_store": "store year",
    "r8_year": "year", "r8_month": "month", "r8_day": "day", "r9": "cpi", "r10": "dept",
    "report1_grid": "store is_holiday", "report2_pivot": "bucket_ord", "report3_area": "size store",
    "report3_top6": "rank", "report4_lines": "type month", "report5_markdowns": "year", "report5_long": "year markdown",
    "report6_bars": "type bar_pos", "report6_share": "type", "report7_share": "year", "report7_top15": "rank",
    "report8_days": "day", "report9_curve": "cpi", "report9_peaks": "rank", "report10_depts": "dept", "report10_top5": "rank",
}


@pytest.mark.parametrize("name", sorted(ORDER))
def test_rows_come_in_order(spark, name):
    from weekly_mart.plans import registry

    rows = registry.queries()[name](spark, SF).collect()
    keys = [tuple(-r[k[1:]] if k[0] == "-" else r[k] for k in ORDER[name].split()) for r in rows]
    assert len(keys) > 1
    assert keys == sorted(keys)


def test_calendar_and_rank_order(spark):
    from weekly_mart.plans import registry

    months = [r["month_name"] for r in registry.queries()["r8_month"](spark, SF).collect()]
    assert months[:3] == ["January", "February", "March"]
    top = registry.queries()["report3_top6"](spark, SF).collect()
    assert [r["rank"] for r in top] == [1, 2, 3, 4, 5, 6]
    assert [r["weekly_sales"] for r in top] == sorted((r["weekly_sales"] for r in top), reverse=True)
