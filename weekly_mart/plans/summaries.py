"""Gold summary tables that the reports read instead of the fact.

Every report except r10 (department) groups by store, date, CPI (a
store-week attribute) or store-version attributes, and every measure it
sums (sales, fuel price, markdowns) is additive. So the fact is summed once
to

- ``sales_daily``: fact x date_dim, one row per (store, date), carrying the
  holiday flag and the store-week CPI;
- ``sales_versioned``: fact x date_dim x store_dim live at the date (the
  fact's own interval rule), one row per (store version, date,
  temperature bucket);

each about (number of departments) times smaller than the fact. Fifteen
reports then scan a small table and the point-in-time join runs once, not
five times. Results are identical: decimal sums are exact, MIN of MINs is
the MIN, and NULL-only groups stay NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.functions import bucket_ord, temp_bucket
from weekly_mart.operators.pit import pit_condition
from weekly_mart.schemas import (
    MARKDOWNS, STORE_DIM_CHECK, STORE_DIM_KEYS, SUM_MEASURE, SUM_MONEY, VALID_FROM, VALID_TO,
)


def _fact_date(fact: DataFrame, date_dim: DataFrame) -> DataFrame:
    dd = date_dim.select("date_id", "store_date", "is_holiday")
    return fact.alias("f").join(dd.alias("d"), F.col("f.date_id") == F.col("d.date_id"))


def sales_daily(fact: DataFrame, date_dim: DataFrame) -> DataFrame:
    return (
        _fact_date(fact, date_dim)
        .groupBy(
            F.col("f.store_id").alias("store_id"),
            F.col("d.store_date").alias("store_date"),
            F.col("d.is_holiday").alias("is_holiday"),
            F.col("f.cpi").alias("cpi"),  # from the store-week row: one value per (store, date)
        )
        .agg(
            F.sum("f.store_weekly_sales").cast(SUM_MONEY).alias("weekly_sales"),
            F.sum("f.fuel_price").cast(SUM_MEASURE).alias("fuel_price"),
            *[F.sum(f"f.{m}").cast(SUM_MONEY).alias(m) for m in MARKDOWNS],
        )
    )


def sales_versioned(
    fact: DataFrame, date_dim: DataFrame, store_dim: DataFrame, boundary: str = "closed"
) -> DataFrame:
    t = F.col("f.store_temperature")
    return (
        _fact_date(fact, date_dim)
        .join(
            store_dim.select(*STORE_DIM_KEYS, *STORE_DIM_CHECK, VALID_FROM, VALID_TO).alias("s"),
            pit_condition("f", "s", STORE_DIM_KEYS, F.col("d.store_date"), boundary),
        )
        .groupBy(
            F.col("s.store_id").alias("store_id"),
            F.col("s.store_type").alias("store_type"),
            F.col("s.store_size").alias("store_size"),
            F.col("d.store_date").alias("store_date"),
            temp_bucket(t).alias("temp_bucket"),
            bucket_ord(t).alias("bucket_ord"),
        )
        .agg(F.sum("f.store_weekly_sales").cast(SUM_MONEY).alias("weekly_sales"))
    )
