"""Column expressions: temperature buckets (edges, NULL), month names."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from weekly_mart.functions import bucket_ord, month_name, temp_bucket


def test_temperature_bucket_edges_and_null(spark):
    vals = [Decimal("-0.0001"), Decimal("0"), Decimal("9.9999"), Decimal("10"), Decimal("89.9999"),
            Decimal("90"), Decimal("120"), None]
    df = spark.createDataFrame([(v,) for v in vals], "t decimal(10,4)")
    got = [(r.b, r.o) for r in df.select(temp_bucket("t").alias("b"), bucket_ord("t").alias("o")).collect()]
    assert got == [("< 0", 0), ("0-10", 1), ("0-10", 1), ("10-20", 2), ("80-90", 9),
                   ("> 90", 10), ("> 90", 10), ("> 90", 10)]


def test_month_name_is_full(spark):
    df = spark.createDataFrame([(dt.date(2012, 2, 10),)], "d date")
    assert df.select(month_name("d")).first()[0] == "February"
    assert df.select(F.date_format("d", "MMM dd, yyyy")).first()[0] == "Feb 10, 2012"
