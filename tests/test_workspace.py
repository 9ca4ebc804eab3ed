"""Versioned writes: a failed or dying job never damages the table, nor a reader of it."""

import pytest
from pyspark.sql import functions as F


def _ids(df):
    return sorted(r.id for r in df.collect())


def test_failed_rewrite_keeps_old_table(spark, scratch):
    target = scratch.path("gold", "t")
    scratch.write(spark.range(5), target)
    bad = spark.range(100).select(
        F.when(F.col("id") < 90, F.col("id")).otherwise(F.raise_error(F.lit("task failure"))).alias("id")
    )
    with pytest.raises(Exception, match="task failure"):
        scratch.write(bad, target)
    assert _ids(scratch.read(target)) == [0, 1, 2, 3, 4]
    assert len(scratch._versions(target)) == 1


def test_rewrite_of_the_table_being_read(spark, scratch):
    target = scratch.path("gold", "u")
    scratch.write(spark.range(3), target)
    before = scratch.read(target)
    scratch.write(before.withColumn("id", F.col("id") + 10), target)  # reads target, writes target
    assert _ids(scratch.read(target)) == [10, 11, 12]
    assert _ids(before) == [0, 1, 2]  # opened before the run, still readable


def test_a_version_without_its_marker_does_not_count(spark, scratch):
    target = scratch.path("gold", "w")
    scratch.write(spark.range(3), target)
    dead = scratch.write(spark.range(9), target)
    scratch.delete(f"{dead}/_SUCCESS")  # a driver that died before the commit
    assert _ids(scratch.read(target)) == [0, 1, 2]
    scratch.write(spark.range(1), target)  # the next write goes beyond both
    assert _ids(scratch.read(target)) == [0]


def test_replaced_versions_expire(spark, scratch, monkeypatch):
    import weekly_mart.sources.workspace as module

    target = scratch.path("gold", "x")
    scratch.write(spark.range(1), target)
    monkeypatch.setattr(module, "KEEP_SECONDS", -60)
    scratch.write(spark.range(2), target)
    assert len(scratch._versions(target)) == 1 and _ids(scratch.read(target)) == [0, 1]


def test_snapshot_history_survives_a_run_that_dies(spark, scratch):
    from weekly_mart.operators import dims

    target = scratch.path("gold", "dim")

    def run(size, day):
        source = spark.createDataFrame([(1, 1, "A", size)], "store_id int, dept_id int, store_type string, store_size int")
        return dims.run_snapshot(
            scratch, target, source, ["store_id", "dept_id"], ["store_type", "store_size"], as_of=f"2020-01-{day} 00:00:00"
        )

    run(10, "01")
    run(20, "02")
    dead = scratch.current(target)
    run(30, "03")
    scratch.delete(f"{scratch.current(target)}/_SUCCESS")  # the third run died at its commit
    assert scratch.current(target) == dead
    rows = sorted((r.store_size, str(r.vrsn_end_date)) for r in run(30, "04").collect())
    assert rows == [(10, "2020-01-02 00:00:00"), (20, "2020-01-04 00:00:00"), (30, "None")]


def test_materialize_reuses_a_complete_table(spark, scratch):
    target = scratch.path("gold", "v")
    calls = []

    def build():
        calls.append(1)
        return spark.range(2)

    scratch.materialize(target, build)
    scratch.materialize(target, build)
    assert len(calls) == 1
