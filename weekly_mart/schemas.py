"""Schemas and fixed values of the data model."""

from pyspark.sql import types as T

# Raw (Bronze) tables: every column is text, loaded by position from CSV.
STORES_RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("store", "type", "size")])
FACT_RAW = T.StructType(
    [
        T.StructField(c, T.StringType())
        for c in (
            "store", "date", "temperature", "fuel_price",
            "markdown1", "markdown2", "markdown3", "markdown4", "markdown5",
            "cpi", "unemployment", "isholiday",
        )
    ]
)
DEPARTMENT_RAW = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("store", "dept", "date", "weekly_sales", "isholiday")]
)

RAW_SCHEMAS = {"stores": STORES_RAW, "fact": FACT_RAW, "department": DEPARTMENT_RAW}

# Typed column types of the Silver layer.
INT = "int"
MONEY = "decimal(14,2)"      # weekly_sales, markdown1..5
MEASURE = "decimal(10,4)"    # temperature, fuel_price, unemployment
INDEX = "decimal(14,6)"      # cpi

# Report sums are widened to one type so every engine agrees on it.
SUM_MONEY = "decimal(38,2)"
SUM_MEASURE = "decimal(38,4)"

# --- fixed values that must equal the reference -------------------------
# Markdown columns, in order.
MARKDOWNS = ["markdown1", "markdown2", "markdown3", "markdown4", "markdown5"]
# Open-ended version end used by the point-in-time predicate.
FAR_FUTURE = "9999-12-31 00:00:00"
# Temperature buckets: (upper bound exclusive, label); anything else,
# including NULL temperature, falls to the last label.
TEMP_BUCKETS = [
    (0, "< 0"), (10, "0-10"), (20, "10-20"), (30, "20-30"), (40, "30-40"),
    (50, "40-50"), (60, "50-60"), (70, "60-70"), (80, "70-80"), (90, "80-90"),
]
TEMP_BUCKET_ELSE = "> 90"
# Snapshot check columns and key of the store dimension.
STORE_DIM_KEYS = ["store_id", "dept_id"]
STORE_DIM_CHECK = ["store_type", "store_size"]
# ------------------------------------------------------------------------

# Validity columns of SCD2 dimensions.
VALID_FROM = "vrsn_start_date"
VALID_TO = "vrsn_end_date"
