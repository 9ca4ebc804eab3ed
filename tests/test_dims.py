"""Date dimension rebuild and SCD1 upsert."""

import datetime as dt

from weekly_mart.operators import dims, quality

D = dt.date


def _stg(spark, rows):
    return spark.createDataFrame(rows, "store_date date, is_holiday boolean")


def test_date_dim_ids_follow_date_then_flag(spark):
    stg = _stg(spark, [(D(2012, 2, 10), True), (D(2012, 2, 3), False), (D(2012, 2, 10), False),
                       (D(2012, 2, 3), False)])
    dd = dims.date_dim(stg, as_of="2013-01-01 00:00:00")
    assert [(r.date_id, r.store_date, r.is_holiday) for r in dd.orderBy("date_id").collect()] == [
        (1, D(2012, 2, 3), False), (2, D(2012, 2, 10), False), (3, D(2012, 2, 10), True)]
    # a date with both flags is reported by the uniqueness test on store_date
    assert quality.unique(dd, "date_dim", ["store_date"]).first().failures == 1


def test_scd1_upsert_keeps_ids_and_numbers_new_keys(spark):
    dim = dims.date_dim(_stg(spark, [(D(2012, 1, 6), False), (D(2012, 1, 13), False)]), as_of="2012-01-20 00:00:00")
    inc = _stg(spark, [(D(2012, 1, 13), True), (D(2012, 1, 20), False), (D(2011, 12, 30), False)])
    out = {r.store_date: r for r in dims.scd1_upsert(dim, inc, as_of="2012-02-01 00:00:00").collect()}
    assert out[D(2012, 1, 6)].date_id == 1 and str(out[D(2012, 1, 6)].update_date) == "2012-01-20 00:00:00"
    assert out[D(2012, 1, 13)].date_id == 2 and out[D(2012, 1, 13)].is_holiday is True
    assert str(out[D(2012, 1, 13)].update_date) == "2012-02-01 00:00:00"
    assert str(out[D(2012, 1, 13)].insert_date) == "2012-01-20 00:00:00"
    # new keys get ids after the maximum, in key order
    assert (out[D(2011, 12, 30)].date_id, out[D(2012, 1, 20)].date_id) == (3, 4)


def test_quality_counts(spark):
    df = spark.createDataFrame([(1, None, -3.0), (1, 2, 4.0), (None, 3, None)], "a int, b int, s double")
    got = {(r.test, r.column_name): r.failures
           for r in quality.column_tests(df, "t", not_null=["a", "b", "s"], positive=["s"]).collect()}
    assert got == {("not_null", "a"): 1, ("not_null", "b"): 1, ("not_null", "s"): 1, ("positive", "s"): 1}
    assert quality.unique(df, "t", ["a"]).first().failures == 1


def test_row_counts_expected(spark):
    a = spark.range(3)
    got = {r.table_name: (r.rows, r.ok) for r in quality.row_counts({"a": a, "b": a}, {"a": 3, "b": 4}).collect()}
    assert got == {"a": (3, True), "b": (3, False)}


def test_stg_date_format(spark):
    from weekly_mart.operators import silver

    raw = spark.createDataFrame([("1", "5", "02/10/2012", "1.5", "TRUE")], "store string, dept string,"
                                " date string, weekly_sales string, isholiday string")
    (r,) = silver.stg_department(raw, date_fmt="MM/dd/yyyy").collect()
    assert r.store_date == D(2012, 2, 10)


def test_session_sizing(spark):
    from weekly_mart.session import size_for_input

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        applied = size_for_input(spark, 100 * 1024**4)  # 100 TB of input
        if "spark.sql.shuffle.partitions" in applied:
            assert int(applied["spark.sql.shuffle.partitions"]) == 200_000 or int(
                applied["spark.sql.shuffle.partitions"]) >= 100_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_scd1_rejects_duplicate_keys(spark):
    import pytest

    dim = dims.date_dim(_stg(spark, [(D(2012, 1, 6), False)]), as_of="2012-01-20 00:00:00")
    inc = _stg(spark, [(D(2012, 1, 13), True), (D(2012, 1, 13), False)])
    with pytest.raises(Exception, match="duplicate"):
        dims.scd1_upsert(dim, inc).collect()


def test_store_dim_source_has_no_cap_on_departments(spark):
    stores = spark.createDataFrame([(s, "A", 10) for s in range(3)], "store_id int, store_type string, store_size int")
    sales = spark.range(20_000).selectExpr("cast(id as int) as dept_id")
    source = dims.store_dim_source(stores, sales)
    assert source.count() == 60_000
    assert source.select("store_id", "dept_id").distinct().count() == 60_000
