"""Silver: typed, cleaned views over Bronze (lazy; Catalyst folds them into consumers).

Casts run under ANSI mode, so text that does not parse aborts the job, like
the warehouse casts it replaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.schemas import INDEX, INT, MARKDOWNS, MEASURE, MONEY


def stg_stores(stores_raw: DataFrame) -> DataFrame:
    return stores_raw.select(
        F.col("store").cast(INT).alias("store_id"),
        F.trim("type").alias("store_type"),
        F.col("size").cast(INT).alias("store_size"),
    )


def _date(col: str, fmt: str | None):
    """ISO text by cast (ANSI: bad text fails); other layouts with ``fmt``."""
    return F.col(col).cast("date") if fmt is None else F.to_date(F.col(col), fmt)


def stg_fact(fact_raw: DataFrame, date_fmt: str | None = None) -> DataFrame:
    return fact_raw.select(
        F.col("store").cast(INT).alias("store_id"),
        _date("date", date_fmt).alias("store_date"),
        F.col("temperature").cast(MEASURE).alias("temperature"),
        F.col("fuel_price").cast(MEASURE).alias("fuel_price"),
        *[F.col(m).cast(MONEY).alias(m) for m in MARKDOWNS],
        F.col("cpi").cast(INDEX).alias("cpi"),
        F.col("unemployment").cast(MEASURE).alias("unemployment"),
        F.col("isholiday").cast("boolean").alias("is_holiday"),
    )


def stg_department(department_raw: DataFrame, date_fmt: str | None = None) -> DataFrame:
    return department_raw.where(F.col("weekly_sales").isNotNull()).select(
        F.col("store").cast(INT).alias("store_id"),
        F.col("dept").cast(INT).alias("dept_id"),
        _date("date", date_fmt).alias("store_date"),
        F.col("weekly_sales").cast(MONEY).alias("weekly_sales"),
        F.col("isholiday").cast("boolean").alias("is_holiday"),
    )
