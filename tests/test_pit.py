"""Point-in-time join boundaries."""

import datetime as dt

from weekly_mart.operators.pit import pit_join

DIM = "k int, v string, vrsn_start_date timestamp_ntz, vrsn_end_date timestamp_ntz"
FACT = "k int, d date"


def _dim(spark):
    t = dt.datetime
    return spark.createDataFrame(
        [(1, "old", t(1990, 1, 1), t(2012, 2, 10)), (1, "new", t(2012, 2, 10), None)], DIM
    )


def test_closed_matches_both_versions_on_boundary(spark):
    f = spark.createDataFrame([(1, dt.date(2012, 2, 10)), (1, dt.date(2012, 2, 3)), (2, dt.date(2012, 1, 1))], FACT)
    got = sorted((r.d.isoformat(), r.v) for r in pit_join(f, _dim(spark), ["k"], "d").collect())
    assert got == [("2012-02-03", "old"), ("2012-02-10", "new"), ("2012-02-10", "old")]


def test_half_open_matches_one_version(spark):
    f = spark.createDataFrame([(1, dt.date(2012, 2, 10)), (1, dt.date(2012, 2, 3))], FACT)
    got = sorted((r.d.isoformat(), r.v) for r in pit_join(f, _dim(spark), ["k"], "d", "half_open").collect())
    assert got == [("2012-02-03", "old"), ("2012-02-10", "new")]


def test_date_is_midnight(spark):
    t = dt.datetime
    dim = spark.createDataFrame([(1, "x", t(2012, 2, 10, 8), None)], DIM)
    f = spark.createDataFrame([(1, dt.date(2012, 2, 10)), (1, dt.date(2012, 2, 11))], FACT)
    assert [r.d.isoformat() for r in pit_join(f, dim, ["k"], "d").collect()] == ["2012-02-11"]


def test_binned_versions_stay_few_and_are_not_broadcast(spark):
    import contextlib
    import io

    from weekly_mart.operators.pit import binned, pit_join, pit_join_binned

    # 300 keys with versions open for years, one with a version a day
    dim = spark.range(300).selectExpr(
        "cast(id as int) k", "explode(array(0, 1)) n", "timestamp_ntz'1990-01-01 00:00:00' a", "timestamp_ntz'1998-07-03 00:00:00' b"
    ).selectExpr("k", "n", "if(n = 0, a, b) vrsn_start_date", "if(n = 0, b, null) vrsn_end_date").unionByName(
        spark.range(900).selectExpr(
            "300 k", "cast(id as int) n", "cast(date_add(date'1996-01-01', cast(id as int)) as timestamp_ntz) vrsn_start_date",
            "cast(date_add(date'1996-01-01', cast(id as int) + 1) as timestamp_ntz) vrsn_end_date",
        )
    )
    fact = spark.range(3000).selectExpr("cast(id % 301 as int) k", "date_add(date'1992-01-03', cast(7 * (id % 360) as int)) d", "id j")
    rows, versions = binned(fact, dim, "d", 28)
    assert versions.count() <= 2 * dim.count()  # a bin of 28 days each would make more than 27,000
    assert rows.count() <= 3 * fact.count()
    for boundary in ("closed", "half_open"):
        got = pit_join_binned(fact, dim, ["k"], "d", boundary)
        want = pit_join(fact, dim, ["k"], "d", boundary)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain()
    assert "BroadcastHashJoin" not in out.getvalue()
    none = pit_join_binned(fact.limit(0), dim, ["k"], "d")
    assert none.count() == 0 and pit_join_binned(fact, dim.limit(0), ["k"], "d").count() == 0
