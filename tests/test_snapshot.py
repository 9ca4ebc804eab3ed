"""SCD2 snapshot transitions on hand-made rows."""

from pyspark.sql import functions as F

from weekly_mart.operators import dims

KEYS, CHECK = ["store_id", "dept_id"], ["store_type", "store_size"]
SRC = "store_id int, dept_id int, store_type string, store_size int"
T0, T1, T2 = "2010-01-01 00:00:00", "2011-01-07 00:00:00", "2012-03-02 00:00:00"


def rows(df):
    return sorted(
        (r.store_id, r.dept_id, r.store_type, r.store_size, str(r.vrsn_start_date), str(r.vrsn_end_date))
        for r in df.collect()
    )


def test_first_load_backdates(spark):
    src = spark.createDataFrame([(1, 1, "A", 100)], SRC)
    d = dims.snapshot(None, src, KEYS, CHECK, as_of=T1, initial_valid_from="1900-01-01 00:00:00")
    (r,) = d.collect()
    assert str(r.vrsn_start_date) == "1900-01-01 00:00:00" and r.vrsn_end_date is None
    assert str(r.insert_date) == T1


def test_transitions(spark):
    src0 = spark.createDataFrame(
        [(1, 1, "A", 100), (2, 1, "B", 200), (3, 1, "C", None), (4, 1, "A", 50)], SRC
    )
    d0 = dims.snapshot(None, src0, KEYS, CHECK, as_of=T0)
    # 1 unchanged, 2 changes size, 3 unchanged NULL size (NULL-safe), 4 deleted, 5 new
    src1 = spark.createDataFrame(
        [(1, 1, "A", 100), (2, 1, "B", 250), (3, 1, "C", None), (5, 1, "B", 70)], SRC
    )
    d1 = dims.snapshot(d0, src1, KEYS, CHECK, as_of=T1)
    assert rows(d1) == sorted([
        (1, 1, "A", 100, T0, "None"),
        (2, 1, "B", 200, T0, T1),
        (2, 1, "B", 250, T1, "None"),
        (3, 1, "C", None, T0, "None"),
        (4, 1, "A", 50, T0, T1),
        (5, 1, "B", 70, T1, "None"),
    ])
    # key 4 reappears: a new version opens; closed history is untouched
    src2 = src1.unionByName(spark.createDataFrame([(4, 1, "A", 55)], SRC))
    d2 = dims.snapshot(d1, src2, KEYS, CHECK, as_of=T2)
    got = rows(d2)
    assert (4, 1, "A", 50, T0, T1) in got and (4, 1, "A", 55, T2, "None") in got
    assert len(got) == 7
    # audit: closed rows carry the close time in update_date, keep insert_date
    closed = d1.where("store_id = 2 and vrsn_end_date is not null").first()
    assert str(closed.insert_date) == T0 and str(closed.update_date) == T1


def test_same_input_changes_nothing(spark):
    src = spark.createDataFrame([(1, 1, "A", 100), (2, 2, "B", 5)], SRC)
    d0 = dims.snapshot(None, src, KEYS, CHECK, as_of=T0)
    d1 = dims.snapshot(d0, src, KEYS, CHECK, as_of=T1)
    assert sorted(map(tuple, d0.collect())) == sorted(map(tuple, d1.collect()))


def test_keep_hard_deletes_open(spark):
    src0 = spark.createDataFrame([(1, 1, "A", 100), (2, 1, "B", 1)], SRC)
    d0 = dims.snapshot(None, src0, KEYS, CHECK, as_of=T0)
    src1 = spark.createDataFrame([(1, 1, "A", 100)], SRC)
    d1 = dims.snapshot(d0, src1, KEYS, CHECK, as_of=T1, invalidate_hard_deletes=False)
    assert d1.where(F.col("vrsn_end_date").isNull()).count() == 2


def test_source_is_every_store_by_department(spark):
    stores = spark.createDataFrame([(1, "A", 10), (2, "B", 20)], "store_id int, store_type string, store_size int")
    sales = spark.createDataFrame([(1, 7), (1, 7), (2, 9)], "store_id int, dept_id int")
    src = dims.store_dim_source(stores, sales)
    assert sorted((r.store_id, r.dept_id) for r in src.collect()) == [(1, 7), (1, 9), (2, 7), (2, 9)]


def test_duplicate_source_keys_fail(spark):
    import pytest

    d0 = dims.snapshot(None, spark.createDataFrame([(1, 1, "A", 1)], SRC), KEYS, CHECK, as_of=T0)
    dup = spark.createDataFrame([(1, 1, "A", 1), (1, 1, "B", 2)], SRC)
    with pytest.raises(Exception, match="duplicate"):
        dims.snapshot(d0, dup, KEYS, CHECK, as_of=T1).collect()


def test_run_snapshot_in_place_keeps_history(spark, scratch):
    target = scratch.path("gold", "store_dim")
    dims.run_snapshot(scratch, target, spark.createDataFrame([(1, 1, "A", 1)], SRC), KEYS, CHECK, as_of=T0)
    dims.run_snapshot(scratch, target, spark.createDataFrame([(1, 1, "A", 2)], SRC), KEYS, CHECK, as_of=T1)
    out = dims.run_snapshot(scratch, target, spark.createDataFrame([(1, 1, "A", 2)], SRC), KEYS, CHECK, as_of=T2)
    assert rows(out) == [(1, 1, "A", 1, T0, T1), (1, 1, "A", 2, T1, "None")]


def test_duplicate_keys_fail_on_first_load(spark):
    import pytest

    dup = spark.createDataFrame([(1, 1, "A", 1), (1, 1, "B", 2)], SRC)
    with pytest.raises(Exception, match="duplicate"):
        dims.snapshot(None, dup, KEYS, CHECK, as_of=T0).collect()
