"""Raw store-sales tables derived from the driver's test tables.

The test data has no store sales, so the three raw tables are derived
(rules in FIXTURES.md §3): supplier -> store, part -> department
(99 departments), ship week (its Friday) -> sale date, signed line price
(returns negative) -> weekly sales, integer arithmetic -> weather, prices and
markdowns. ``NA`` marks missing values in the text, as in the source files.

Two store files model two uploads of the store list: the later one changes
sizes (keys ending in 3), adds stores and drops stores, so the SCD2 snapshot
sees inserts, changes and hard deletes.

The derivation is one aggregation of ``lineitem`` (partial aggregation on the
map side, shuffle on the group key) plus a projection of ``supplier``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Times of the two store uploads (snapshot runs) in the fixture; the second
# is a Friday, i.e. a sale date, so the version boundary is hit exactly.
FIRST_LOAD_AT = "1990-01-01 00:00:00"
CHANGE_AT = "1998-07-03 00:00:00"
# Audit time stamped on rebuilt Gold tables in the fixture run.
BUILD_AT = "2000-01-01 00:00:00"

_HOLIDAY = (
    "case when ((month(d)=2 and day(d) between 6 and 12) or (month(d)=9 and day(d) between 4 and 10)"
    " or (month(d)=11 and day(d) between 22 and 28) or (month(d)=12 and day(d) between 25 and 31))"
    " then 'TRUE' else 'FALSE' end"
)


def _sale_friday(ts: str):
    """Friday of the (Monday-based) week of a ship timestamp."""
    return F.date_add(F.trunc(F.col(ts).cast("date"), "week"), 4)


def department_raw(lineitem: DataFrame) -> DataFrame:
    groups = (
        lineitem.select(
            F.col("l_suppkey").alias("sk"),
            (F.col("l_partkey") % 99 + 1).alias("dept"),
            _sale_friday("l_shipdate").alias("d"),
            (
                F.col("l_extendedprice").cast("decimal(14,2)")
                * F.when(F.col("l_returnflag") == "R", -1).otherwise(1)
            ).alias("v"),
        )
        .groupBy("sk", "dept", "d")
        .agg(F.sum("v").alias("v"))
    )
    return groups.selectExpr(
        "cast(sk + 1 as string) store",
        "cast(dept as string) dept",
        "cast(d as string) date",
        "cast(case when (sk + dept) % 23 = 0 then null else v end as string) weekly_sales",
        f"{_HOLIDAY} isholiday",
    )


def fact_raw(lineitem: DataFrame) -> DataFrame:
    weeks = (
        lineitem.select(F.col("l_suppkey").alias("sk"), _sale_friday("l_shipdate").alias("d"))
        .distinct()
        .withColumn("w", F.expr("datediff(d, date'1995-01-01') div 7"))
    )

    def markdown(i: int, mod: int, mult: int) -> str:
        return (
            f"case when (sk + w + {i}) % {mod} < 2 then 'NA' else cast(cast(((sk*{3 + i} + w*{mult}) % 9000)"
            f" * 0.25 as decimal(14,2)) as string) end markdown{i}"
        )

    return weeks.selectExpr(
        "cast(sk + 1 as string) store",
        "cast(d as string) date",
        "case when (sk + w) % 41 = 0 then 'NA' else"
        " cast(cast(((sk*37 + w*53) % 1300) * 0.1 - 15 as decimal(10,4)) as string) end temperature",
        "cast(cast(2.5 + ((sk*3 + w) % 170) * 0.01 as decimal(10,4)) as string) fuel_price",
        markdown(1, 4, 18),
        markdown(2, 3, 25),
        markdown(3, 4, 32),
        markdown(4, 3, 39),
        markdown(5, 4, 46),
        "case when w % 29 = 0 then 'NA' else"
        " cast(cast(126 + ((sk*13) % 100) + w * 0.00317 as decimal(14,6)) as string) end cpi",
        "cast(cast(4 + ((sk*7 + w) % 90) * 0.1 as decimal(10,4)) as string) unemployment",
        f"{_HOLIDAY} isholiday",
    )


def stores_raw(supplier: DataFrame, upload: int) -> DataFrame:
    """Store list as uploaded the first (0) or second (1) time."""
    kind = "case s_nationkey % 3 when 0 then 'A' when 1 then 'B' else 'C' end"
    if upload == 0:
        size, listed = "30000 + (s_suppkey*7919) % 190000", "s_suppkey % 20 <> 7"
    else:
        size = "30000 + (s_suppkey*7919) % 190000 + case when s_suppkey % 10 = 3 then 5000 else 0 end"
        listed = "s_suppkey % 50 <> 49"
    return supplier.where(listed).selectExpr(
        "cast(s_suppkey + 1 as string) store",
        f"concat(' ', {kind}, ' ') type",
        f"cast({size} as string) size",
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four landing tables: department, fact, stores (current), stores_v0."""
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    return {
        "department": department_raw(lineitem),
        "fact": fact_raw(lineitem),
        "stores_v0": stores_raw(supplier, 0),
        "stores": stores_raw(supplier, 1),
    }
