"""The 16 report queries over the star schema.

Reports r1-r9 read the Gold summaries (``plans/summaries.py``): the fact
summed once per store-day (with its CPI), and once per store-version-day
after the point-in-time join to the store dimension. r10 (department)
needs a fact-level key and reads the fact. Every report is a grouped
aggregation (partial on the map side, final after the shuffle of groups),
then a sort of the few result rows. Sums are widened to decimal(38, s).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.functions import month_name
from weekly_mart.plans.pipeline import Gold
from weekly_mart.schemas import MARKDOWNS, SUM_MEASURE, SUM_MONEY


def _order(df: DataFrame, ordered: bool, *cols) -> DataFrame:
    """Presentation order of a report; data sets built on a report skip it
    (a sort under an order-sensitive consumer could not be removed)."""
    return df.orderBy(*cols) if ordered and cols else df


def _sum(col: str, dtype: str = SUM_MONEY, alias: str | None = None):
    return F.sum(col).cast(dtype).alias(alias or col)


def r1_holiday(g: Gold, ordered: bool = True) -> DataFrame:
    return g.daily.groupBy("is_holiday").agg(_sum("weekly_sales"))


def r1_store(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.daily.groupBy(F.col("store_id").alias("store"), "is_holiday")
            .agg(_sum("weekly_sales"))
        ),
        ordered,
        "store", "is_holiday",
    )


def r1_kpi(g: Gold, ordered: bool = True) -> DataFrame:
    return g.daily.agg(
        _sum("weekly_sales", alias="total_sales"), F.min("is_holiday").alias("first_is_holiday")
    )


def r2(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.versioned.groupBy("temp_bucket", "bucket_ord", F.year("store_date").alias("year"))
            .agg(_sum("weekly_sales"), F.min("store_date").alias("earliest_date"))
        ),
        ordered,
        "year", "bucket_ord",
    )


def r3(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.versioned.groupBy(F.col("store_id").alias("store"), F.col("store_size").alias("size"))
            .agg(_sum("weekly_sales"))
        ),
        ordered,
        "size", "store",
    )


def r4(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.versioned.groupBy(
                F.month("store_date").alias("month"),
                month_name("store_date").alias("month_name"),
                F.col("store_type").alias("type"),
            )
            .agg(_sum("weekly_sales"))
        ),
        ordered,
        "month", "type",
    )


def r5(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(g.daily.groupBy(F.year("store_date").alias("year")).agg(*[_sum(m) for m in MARKDOWNS]), ordered, "year")


def r6_type(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(g.versioned.groupBy(F.col("store_type").alias("type")).agg(_sum("weekly_sales")), ordered, "type")


def r6_store(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.versioned.groupBy(F.col("store_type").alias("type"), F.col("store_id").alias("store"))
            .agg(_sum("weekly_sales"))
        ),
        ordered,
        "type", F.desc("weekly_sales"), "store",
    )


def r7_year(g: Gold, ordered: bool = True) -> DataFrame:
    """Fuel price summed over department rows (the fact's grain), as the reference does."""
    return _order(
        (
            g.daily.groupBy(F.year("store_date").alias("year"))
            .agg(_sum("fuel_price", SUM_MEASURE))
        ),
        ordered,
        "year",
    )


def r7_store(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.daily.groupBy(F.col("store_id").alias("store"), F.year("store_date").alias("year"))
            .agg(_sum("fuel_price", SUM_MEASURE))
        ),
        ordered,
        "store", "year",
    )


def r8_year(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(g.daily.groupBy(F.year("store_date").alias("year")).agg(_sum("weekly_sales")), ordered, "year")


def r8_month(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.daily.groupBy(F.month("store_date").alias("month"), month_name("store_date").alias("month_name"))
            .agg(_sum("weekly_sales"))
        ),
        ordered,
        "month",
    )


def r8_day(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(g.daily.groupBy(F.dayofmonth("store_date").alias("day")).agg(_sum("weekly_sales")), ordered, "day")


def r9(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.daily.where(F.col("cpi").isNotNull())
            .groupBy(F.round("cpi", 2).cast("decimal(14,2)").alias("cpi"))
            .agg(_sum("weekly_sales"))
        ),
        ordered,
        "cpi",
    )


def r10(g: Gold, ordered: bool = True) -> DataFrame:
    return _order(
        (
            g.fact.groupBy(F.col("dept_id").alias("dept"))
            .agg(F.sum("store_weekly_sales").cast(SUM_MONEY).alias("weekly_sales"))
        ),
        ordered,
        "dept",
    )


REPORTS = {
    "r1_holiday": r1_holiday, "r1_store": r1_store, "r1_kpi": r1_kpi, "r2": r2, "r3": r3, "r4": r4,
    "r5": r5, "r6_type": r6_type, "r6_store": r6_store, "r7_year": r7_year, "r7_store": r7_store,
    "r8_year": r8_year, "r8_month": r8_month, "r8_day": r8_day, "r9": r9, "r10": r10,
}
