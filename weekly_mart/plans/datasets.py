"""Report data sets: the numbers behind each chart, built from the report queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.operators import shape
from weekly_mart.plans import reports
from weekly_mart.plans.pipeline import Gold
from weekly_mart.schemas import MARKDOWNS


def report1_grid(g: Gold) -> DataFrame:
    """Store x holiday flag, every cell present (0 when a store has no sales for a flag)."""
    return shape.densify(reports.r1_store(g, ordered=False), "store", "is_holiday", "weekly_sales").orderBy(
        "store", "is_holiday"
    )


def report2_pivot(g: Gold) -> DataFrame:
    """Temperature bucket x year (one column per year), buckets in display order."""
    return shape.pivot_sum(reports.r2(g, ordered=False), ["temp_bucket", "bucket_ord"], "year", g.years, "weekly_sales").orderBy(
        "bucket_ord"
    )


def report2_earliest(g: Gold) -> DataFrame:
    return reports.r2(g, ordered=False).agg(F.min("earliest_date").alias("earliest_date")).withColumn(
        "earliest_label", F.date_format("earliest_date", "MMM dd, yyyy")
    )


def report3_area(g: Gold) -> DataFrame:
    """Sales by store size, along the size axis."""
    return reports.r3(g, ordered=False).orderBy("size", "store")


def report3_top6(g: Gold) -> DataFrame:
    return shape.top_k(reports.r3(g, ordered=False), 6, [F.desc("weekly_sales"), F.asc("size"), F.asc("store")], "rank")


def report4_lines(g: Gold) -> DataFrame:
    """One series per store type, months in calendar order (long form)."""
    return reports.r4(g, ordered=False).orderBy("type", "month")


def report5_markdowns(g: Gold) -> DataFrame:
    """Year x the markdown columns that exist (wide, one bar group per year)."""
    r5 = reports.r5(g, ordered=False)
    return r5.select("year", *[m for m in MARKDOWNS if m in r5.columns]).orderBy("year")


def report5_long(g: Gold) -> DataFrame:
    r5 = reports.r5(g, ordered=False)
    present = [m for m in MARKDOWNS if m in r5.columns]
    return r5.unpivot(["year"], present, "markdown", "amount").orderBy("year", "markdown")


def report6_bars(g: Gold) -> DataFrame:
    """Stores ascending by sales within each type, labelled ``type-store``.

    A type's stores are numbered by stretches of sales magnitude, not in one task."""
    bars = reports.r6_store(g, ordered=False).withColumn(
        "label", F.concat_ws("-", "type", F.col("store").cast("string"))
    )
    return shape.number_in_order(
        bars, ["weekly_sales", "store"], shape.magnitude("weekly_sales"), "bar_pos", group=["type"]
    ).orderBy("type", "bar_pos")


def report6_share(g: Gold) -> DataFrame:
    return shape.share(reports.r6_type(g, ordered=False), "weekly_sales").orderBy("type")


def report7_top15(g: Gold) -> DataFrame:
    """Store x year fuel pivot; the 15 stores highest in the latest year (ties by store)."""
    wide = shape.pivot_sum(reports.r7_store(g, ordered=False), ["store"], "year", g.years, "fuel_price")
    order = ([F.desc(f"`{g.years[-1]}`")] if g.years else []) + [F.asc("store")]
    return shape.top_k(wide, 15, order, "rank")


def report7_share(g: Gold) -> DataFrame:
    return shape.share(reports.r7_year(g, ordered=False), "fuel_price").orderBy("year")


def report8_days(g: Gold) -> DataFrame:
    return reports.r8_day(g, ordered=False).orderBy("day")


def report8_best_month(g: Gold) -> DataFrame:
    return shape.best_by(reports.r8_month(g, ordered=False), "weekly_sales", "month", ["month", "month_name", "weekly_sales"])


def report9_curve(g: Gold) -> DataFrame:
    return reports.r9(g, ordered=False).orderBy("cpi")


def report9_peaks(g: Gold) -> DataFrame:
    return shape.top_k(reports.r9(g, ordered=False), 6, [F.desc("weekly_sales"), F.asc("cpi")], "rank")


def report10_depts(g: Gold) -> DataFrame:
    return reports.r10(g, ordered=False).orderBy("dept")


def report10_top5(g: Gold) -> DataFrame:
    return shape.top_k(reports.r10(g, ordered=False), 5, [F.desc("weekly_sales"), F.asc("dept")], "rank")


def report10_total(g: Gold) -> DataFrame:
    return reports.r10(g, ordered=False).agg(F.sum("weekly_sales").cast("decimal(38,2)").alias("grand_total"))


DATASETS = {
    "report1_grid": report1_grid, "report2_pivot": report2_pivot, "report2_earliest": report2_earliest,
    "report3_area": report3_area, "report3_top6": report3_top6, "report4_lines": report4_lines,
    "report5_markdowns": report5_markdowns, "report5_long": report5_long, "report8_days": report8_days,
    "report9_curve": report9_curve, "report10_depts": report10_depts,
    "report6_bars": report6_bars, "report6_share": report6_share, "report7_top15": report7_top15,
    "report7_share": report7_share, "report8_best_month": report8_best_month,
    "report9_peaks": report9_peaks, "report10_top5": report10_top5, "report10_total": report10_total,
}
