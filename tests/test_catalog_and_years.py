"""Bucketed catalog tables, tables by sale year, binned point-in-time join, bucketed snapshots, counts from writes."""

import datetime as dt
import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from weekly_mart.operators import by_year, dims, quality
from weekly_mart.operators.pit import pit_join, pit_join_binned
from weekly_mart.operators.snapshot_buckets import read_snapshot, refresh_snapshot
from weekly_mart.sources.catalog import Catalog

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _sides_of_pit_join(plan):
    """The operators below each side of the join on (store_id, dept_id)."""
    lines = plan.split("\n")
    at = next(i for i, x in enumerate(lines) if "SortMergeJoin" in x and "dept_id" in x)
    depth = len(re.match(r"[ :]*", lines[at])[0])
    below = []
    for x in lines[at + 1 :]:
        if len(re.match(r"[ :]*", x)[0]) <= depth:
            break
        below.append(x)
    return below


def test_tables_are_found_by_another_session(spark, scratch):
    home = scratch.path("cat")
    catalog = Catalog(scratch, home, "wm_test")
    rows = spark.range(100).select((F.col("id") % 7).cast("int").alias("k"), F.col("id").cast("string").alias("v"))
    catalog.replace("gold", "t", rows, ["k"], 4)
    assert spark.sql("SELECT count(*) FROM wm_test_gold.t WHERE k = 3").first()[0] == 14
    catalog.replace("gold", "t", rows.where("k < 3"), ["k"], 4)  # replaced under its name
    assert spark.table("wm_test_gold.t").count() == 44
    spark.sql("DROP TABLE wm_test_gold.t")  # as in a session that starts with an empty catalog
    assert Catalog(scratch, home, "wm_test").attach_all() == ["wm_test_gold.t"]
    other = spark.newSession()
    assert other.sql("SELECT count(DISTINCT k) FROM wm_test_gold.t").first()[0] == 3
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED wm_test_gold.t").collect()}
    assert detail["Num Buckets"] == "4" and "k" in detail["Bucket Columns"]
    for table in spark.catalog.listTables("wm_test_gold"):
        assert table.name == "t"
    spark.sql("DROP DATABASE wm_test_gold CASCADE")


def test_equal_buckets_join_without_a_shuffle(spark, scratch, no_broadcast):
    catalog = Catalog(scratch, scratch.path("cat2"), "wm_test2")
    facts = spark.range(500).select(
        (F.col("id") % 5).cast("int").alias("store_id"), (F.col("id") % 7).cast("int").alias("dept_id"),
        F.expr("date_add(DATE '2010-01-01', CAST(id AS INT))").alias("d"),
    )
    versions = spark.range(35).select(
        (F.col("id") % 5).cast("int").alias("store_id"), (F.col("id") % 7).cast("int").alias("dept_id"),
        F.lit("2010-01-01").cast("timestamp_ntz").alias("vrsn_start_date"), F.lit(None).cast("timestamp_ntz").alias("vrsn_end_date"),
    )
    keys = ["store_id", "dept_id"]
    f, v = catalog.replace("silver", "f", facts, keys, 4), catalog.replace("gold", "v", versions, keys, 4)
    joined = pit_join(f, v, keys, "d")
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, pit_join(facts, versions, keys, "d").collect()))
    assert "Exchange" in _plan(pit_join(facts, versions, keys, "d"))


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_fact_and_summary_meet_versions_without_a_shuffle(spark, no_broadcast):
    from weekly_mart.operators.fact import build_fact
    from weekly_mart.plans.pipeline import mart

    m = mart(spark, SF)
    m.fact_bucketed()
    for df in (
        build_fact(m.sales_bucketed(), m.store_dim_bucketed(), m.stg_fact(), m.date_dim()),
        m.fact_bucketed().alias("f").join(
            m.store_dim_bucketed().alias("s"), ["store_id", "dept_id"]
        ),
    ):
        below = _sides_of_pit_join(_plan(df))
        assert any("Bucketed: true" in x for x in below)
        assert not any("Exchange" in x for x in below)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_a_year_filter_prunes_partitions(spark):
    from weekly_mart.plans.pipeline import mart

    rows = mart(spark, SF).fact_by_year().where("sale_year = 1997").groupBy("dept_id").agg(F.sum("store_weekly_sales"))
    assert re.search(r"PartitionFilters: \[[^\]]*sale_year", _plan(rows))


def test_changed_years_are_built_by_one_job(spark, scratch):
    target, asked = scratch.path("years"), []

    def build(years):
        asked.append(tuple(years))
        rows = spark.range(30).select((F.col("id") % 3 + 2010).cast("int").alias("sale_year"), F.col("id").alias("v"))
        return rows.where(F.col("sale_year").isin(years))

    first = by_year.refresh(scratch, target, {2010: "a", 2011: "a", 2012: "a"}, build)
    assert first.count() == 30 and set(asked) == {(2010, 2011, 2012)}
    asked.clear()
    by_year.refresh(scratch, target, {2010: "a", 2011: "b", 2012: "b"}, build)
    assert set(asked) == {(2011, 2012)}  # both changed years in one read
    assert sorted(os.path.relpath(p, target.replace("file:", "")) for p in glob.glob(f"{target.replace('file:', '')}/*/build=*")) == [
        "sale_year=2010/build=a", "sale_year=2011/build=a", "sale_year=2011/build=b",
        "sale_year=2012/build=a", "sale_year=2012/build=b"]
    assert first.count() == 30  # opened before: its parts are still there
    # a year that lost its rows, and a run that died after the files but before the mark
    gone = by_year.refresh(scratch, target, {2010: "a", 2013: "c"}, build)
    assert gone.count() == 10
    scratch.delete(f"{target}/sale_year=2010/build=a/_SUCCESS")
    assert by_year.refresh(scratch, target, {2010: "a"}, build).count() == 10
    assert by_year.refresh(scratch, target, {}, build).count() == 0


@pytest.mark.parametrize("boundary", ["closed", "half_open"])
def test_binned_join_with_thousands_of_versions_of_a_key(spark, boundary):
    rng = random.Random(8)
    day = dt.datetime(2010, 1, 1)
    versions, t = [], dt.datetime(1900, 1, 1)
    steps = [day + dt.timedelta(hours=12 * k) for k in range(3000)]
    for k, end in enumerate([*steps, None]):
        versions.append((1, "a", t, end, k))
        t = end
    for key in (2, 3):
        cuts = [dt.datetime(1990, 1, 1), *sorted(day + dt.timedelta(days=rng.randrange(1500)) for _ in range(20)), None]
        versions += [(key, "b", a, b, k) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    schema = "k int, g string, vrsn_start_date timestamp_ntz, vrsn_end_date timestamp_ntz, n int"
    dim = spark.createDataFrame(versions, schema)
    facts = [(rng.choice([1, 2, 3]), rng.choice("ab"), (day + dt.timedelta(days=rng.randrange(1500))).date(), j) for j in range(400)]
    fact = spark.createDataFrame(facts, "k int, g string, d date, j int")
    expected = sorted(map(tuple, pit_join(fact, dim, ["k", "g"], "d", boundary).collect()), key=str)
    binned = pit_join_binned(fact, dim, ["k", "g"], "d", boundary)
    assert sorted(map(tuple, binned.collect()), key=str) == expected
    assert len(expected) > (400 if boundary == "closed" else 100) / 4
    assert "unix_date" in re.search(r"(?:SortMerge|BroadcastHash|ShuffledHash)Join \[[^\]]*\]", _plan(binned))[0]
    boundary_day = [r for r in expected if r[0] == 1]  # every midnight is a change of versions
    per_fact = {j: sum(1 for r in boundary_day if r[3] == j) for j in {r[3] for r in boundary_day}}
    assert set(per_fact.values()) == ({2} if boundary == "closed" else {1})


def _source(spark, rows):
    return spark.createDataFrame(rows, "store_id int, dept_id int, store_type string, store_size int")


def test_snapshot_by_buckets_equals_the_plain_one(spark, scratch):
    rng = random.Random(3)
    target, plain = scratch.path("buckets"), None
    keys, check = ["store_id", "dept_id"], ["store_type", "store_size"]
    state = {(s, d): (rng.choice("AB"), rng.randrange(5)) for s in range(12) for d in range(4)}
    for run in range(5):
        if run == 3:
            state = {k: v for k, v in state.items() if k[0] not in (0, 1, 2)}  # stores go
        elif run:
            for k in rng.sample(sorted(state), 3):
                state[k] = (rng.choice("ABC"), rng.randrange(5))
            state[(100 + run, 1)] = ("A", 1)
        source = _source(spark, [(*k, *v) for k, v in sorted(state.items())])
        as_of = f"201{run}-01-01 00:00:00"
        changed = refresh_snapshot(
            scratch, target, source, keys, check, as_of, f"run{run}", initial_valid_from="1900-01-01 00:00:00", buckets=16
        )
        assert 0 < len(changed) <= 16
        new = dims.snapshot(plain, source, keys, check, as_of, True, "1900-01-01 00:00:00")
        scratch.write(new, scratch.path("plain"))
        plain = scratch.read(scratch.path("plain"))
        columns = plain.columns
        assert sorted(map(str, read_snapshot(scratch, target).select(columns).collect())) == sorted(map(str, plain.collect()))
    assert refresh_snapshot(scratch, target, source, keys, check, "2019-01-01 00:00:00", "again", buckets=16) == []


def test_one_changed_store_rewrites_its_buckets_only(spark, scratch):
    target = scratch.path("one")
    rows = [(s, 1, "A", s) for s in range(200)]
    refresh = lambda r, run: refresh_snapshot(
        scratch, target, _source(spark, r), ["store_id", "dept_id"], ["store_type", "store_size"], "2012-01-01 00:00:00", run)
    refresh(rows, "a")
    written = lambda: {p: os.path.getmtime(p) for p in glob.glob(f"{target.replace('file:', '')}/live/bucket=*/*.parquet")}
    before = written()
    rows[7] = (7, 1, "B", 7)
    assert len(refresh(rows, "b")) == 1
    after = written()
    assert len(set(before) - set(after)) == 1 == len(set(after) - set(before))


def test_a_snapshot_run_that_dies_is_repeated(spark, scratch, monkeypatch):
    from weekly_mart.operators import snapshot_buckets as module

    target, keys, check = scratch.path("dies"), ["store_id", "dept_id"], ["store_type", "store_size"]
    rows = [(s, 1, "A", s) for s in range(50)]
    run = lambda r, name, at: refresh_snapshot(scratch, target, _source(spark, r), keys, check, at, name, buckets=8)
    run(rows, "a", "2010-01-01 00:00:00")
    rows = [(s, d, "B" if s < 20 else t, z) for s, d, t, z in rows if s != 49]
    real, calls = module._overwrite, []

    def dies(df, path, *by):
        calls.append(path)
        if path.endswith("/live"):
            real(df.where("bucket < 3"), path, *by)  # some partitions were moved into place
            raise RuntimeError("driver lost")
        real(df, path, *by)

    monkeypatch.setattr(module, "_overwrite", dies)
    with pytest.raises(RuntimeError):
        run(rows, "b", "2011-01-01 00:00:00")
    monkeypatch.setattr(module, "_overwrite", real)
    run(rows, "b", "2011-01-01 00:00:00")
    got = read_snapshot(scratch, target)
    assert got.where("vrsn_end_date IS NULL").count() == 49
    assert got.where("vrsn_end_date IS NOT NULL").count() == 21
    assert quality.scd2_tests(got, "t", keys).where("failures > 0").count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_counts_and_data_tests_scan_little(spark):
    from weekly_mart.plans.pipeline import mart

    m = mart(spark, SF)
    assert "FileScan" not in _plan(m.row_counts())  # all of them counted while they were written
    scans = re.findall(r"FileScan parquet.*?Location: \S+ \S+/gold/(\w+)/", _plan(m.dq_results()))
    assert sorted(scans) == ["date_dim", "fact_closed", "store_dim"]
    assert len(re.findall(r"ReadSchema: struct<[^>]*weekly_sales", _plan(m.dropped_sales()))) == 1


def test_null_keys_and_empty_tables_in_one_scan(spark):
    rows = [(1, 5, -1.0), (1, None, 2.0), (None, 5, None), (None, 5, 3.0), (2, 6, 1.0)]
    df = spark.createDataFrame(rows, "a int, b int, x double")
    tests = lambda d: {(r.test, r.column_name): r.failures for r in quality.key_and_column_tests(
        d, "t", ["a", "b"], not_null=["a", "b", "x"], positive=["x"]).collect()}
    assert tests(df) == {("unique", "a"): 1, ("unique", "b"): 1, ("not_null", "a"): 2, ("not_null", "b"): 1,
                         ("not_null", "x"): 1, ("positive", "x"): 1}
    assert set(tests(df.where("false")).values()) == {0}


def test_gold_builds_what_is_asked_for(spark):
    from weekly_mart.plans.pipeline import Gold

    class Lazy:
        def __getattr__(self, name):
            raise AssertionError(name)

    class Half(Lazy):
        def store_dim(self):
            return "dim"

    assert Gold(Half(), "half_open").store_dim == "dim"
