"""Fact build: department sales -> live store version, store-week economy, date id."""

from __future__ import annotations

from hashlib import sha1

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.functions import audit_ts
from weekly_mart.operators import by_year
from weekly_mart.operators.pit import binned, pit_condition, same_bin
from weekly_mart.schemas import MARKDOWNS, STORE_DIM_CHECK, STORE_DIM_KEYS, VALID_FROM, VALID_TO

FACT_COLUMNS = [
    "store_id", "dept_id", "date_id", "store_weekly_sales", "fuel_price", "store_temperature",
    "unemployment", "cpi", *MARKDOWNS, VALID_FROM, VALID_TO, "insert_date", "update_date",
]


def build_fact(
    stg_department: DataFrame,
    store_dim: DataFrame,
    stg_fact: DataFrame,
    date_dim: DataFrame,
    boundary: str = "closed",
    as_of: str | None = None,
    bin_days: int | None = None,
) -> DataFrame:
    """Inner joins: sales x store version (point in time) x date x store-week.

    The store version comes first, on (store_id, dept_id): where both tables are
    bucketed on these keys, neither is shuffled. Then the date, then the
    store-week row on (store_id, store_date). The dimensions are written tables,
    so the planner knows their bytes and broadcasts those under
    ``spark.sql.autoBroadcastJoinThreshold``; the others join by sort-merge on
    their keys, with AQE splitting hot keys. Only the columns the fact keeps are
    read. With ``bin_days`` the versions are spread over calendar bins, for keys
    with very many versions (`pit.binned`); else no job runs to build
    the plan.
    """
    ts = audit_ts(as_of)
    sales = stg_department.select("store_id", "dept_id", "store_date", "weekly_sales")
    dates = date_dim.select("date_id", "store_date").alias("dates")
    version = store_dim.select(*STORE_DIM_KEYS, VALID_FROM, VALID_TO)
    week = stg_fact.select(
        "store_id", "store_date", "fuel_price", "temperature", "unemployment", "cpi", *MARKDOWNS
    ).alias("week")

    live = pit_condition("sales", "version", STORE_DIM_KEYS, F.col("sales.store_date"), boundary)
    if bin_days:
        sales, version = binned(sales, version, "store_date", bin_days)
        live = live & same_bin("sales", "version", F.col("sales.store_date"), bin_days)
    j = sales.alias("sales").join(version.alias("version"), live)
    j = j.join(dates, F.col("sales.store_date") == F.col("dates.store_date"))
    j = j.join(
        week,
        (F.col("sales.store_id") == F.col("week.store_id")) & (F.col("sales.store_date") == F.col("week.store_date")),
    )
    return j.select(
        F.col("version.store_id").alias("store_id"),
        F.col("version.dept_id").alias("dept_id"),
        F.col("dates.date_id").alias("date_id"),
        F.col("sales.weekly_sales").alias("store_weekly_sales"),
        F.col("week.fuel_price").alias("fuel_price"),
        F.col("week.temperature").alias("store_temperature"),
        F.col("week.unemployment").alias("unemployment"),
        F.col("week.cpi").alias("cpi"),
        *[F.col(f"week.{m}").alias(m) for m in MARKDOWNS],
        F.col(f"version.{VALID_FROM}").alias(VALID_FROM),
        F.col(f"version.{VALID_TO}").alias(VALID_TO),
        ts.alias("insert_date"),
        ts.alias("update_date"),
    )


def year_marks(
    stg_department: DataFrame, store_dim: DataFrame, stg_fact: DataFrame, date_dim: DataFrame
) -> dict[int, str]:
    """Sale year -> digest of all rows the year's part of the fact and of its summaries is made from.

    One job with one aggregate per input, combined before the shuffle; a few
    rows come back.
    """
    def digest(name: str, df: DataFrame, first, last) -> DataFrame:
        row = F.xxhash64(*df.columns)
        return df.groupBy(first.alias("first"), last.alias("last")).agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(row).alias("x"), F.sum(row % 1_000_003).alias("s")
        ).select(F.lit(name).alias("name"), "first", "last", "n", "x", "s")

    year = F.year("store_date")
    sales = stg_department.select("store_id", "dept_id", "store_date", "weekly_sales")
    versions = store_dim.select(*STORE_DIM_KEYS, *STORE_DIM_CHECK, VALID_FROM, VALID_TO)
    end = F.coalesce(F.col(VALID_TO), F.lit("9999-12-31").cast("timestamp_ntz"))
    rows = (
        digest("sales", sales, year, year)
        .unionByName(digest("weeks", stg_fact, year, year))
        .unionByName(digest("dates", date_dim.select("date_id", "store_date", "is_holiday"), year, year))
        .unionByName(digest("versions", versions, F.year(VALID_FROM), F.year(end)))
        .collect()
    )
    years = sorted(r["first"] for r in rows if r["name"] == "sales" and r["first"] is not None)
    known = sorted(r for r in rows if r["first"] is not None)
    return {
        y: sha1("|".join(str(tuple(r)) for r in known if r["first"] <= y <= r["last"]).encode()).hexdigest()[:16]
        for y in years
    }


def refresh_by_year(
    ws, target: str, stg_department: DataFrame, store_dim: DataFrame, stg_fact: DataFrame, date_dim: DataFrame,
    boundary: str, as_of: str | None, marks: dict[int, str] | None = None,
) -> DataFrame:
    """The fact kept by sale year under ``target`` (`by_year.refresh`), with ``sale_year`` as partition column."""
    if marks is None:
        marks = year_marks(stg_department, store_dim, stg_fact, date_dim)

    def build(years: list[int]) -> DataFrame:
        in_years = F.year("store_date").isin(years)
        dated = date_dim.select("date_id", F.year("store_date").alias("sale_year")).alias("dated")
        rows = build_fact(
            stg_department.where(in_years), store_dim, stg_fact.where(in_years), date_dim.where(in_years), boundary, as_of
        )
        return rows.alias("rows").join(dated, F.col("rows.date_id") == F.col("dated.date_id")).select("rows.*", "dated.sale_year")

    return by_year.refresh(ws, target, marks, build)
