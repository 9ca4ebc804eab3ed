"""Shaping operators: grids, pivots, top-k ties, arg-max ties, shares."""

from decimal import Decimal

from pyspark.sql import functions as F

from weekly_mart.operators import shape


def test_densify_fills_missing_cells(spark):
    df = spark.createDataFrame([(1, True, 5), (2, False, 7)], "store int, h boolean, v int")
    got = sorted(tuple(r) for r in shape.densify(df, "store", "h", "v").collect())
    assert got == [(1, False, 0), (1, True, 5), (2, False, 7), (2, True, 0)]


def test_densify_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, True, 10), (1, None, 5), (None, True, 3)], "store int, h boolean, v int")
    got = sorted((tuple(r) for r in shape.densify(df, "store", "h", "v").collect()), key=repr)
    assert got == sorted([(1, True, 10), (1, None, 5), (None, True, 3), (None, None, 0)], key=repr)


def test_number_in_order(spark):
    rows = [(g, float(v), k) for k, (g, v) in enumerate([("a", -5), ("a", 0), ("a", 1e6), ("a", 3), ("a", 3), ("b", 7), (None, 1)])]
    df = spark.createDataFrame(rows, "g string, v double, k int")
    got = {r.k: r.pos for r in shape.number_in_order(df, ["v", "k"], shape.magnitude("v"), "pos", group=["g"]).collect()}
    assert got == {0: 1, 1: 2, 2: 5, 3: 3, 4: 4, 5: 1, 6: 1}


def test_pivot_fill_and_names(spark):
    df = spark.createDataFrame([("a", 2010, Decimal("1.50")), ("b", 2011, Decimal("2.00"))],
                               "k string, year int, v decimal(38,2)")
    p = shape.pivot_sum(df, ["k"], "year", [2010, 2011], "v")
    assert p.columns == ["k", "2010", "2011"]
    assert sorted(tuple(r) for r in p.collect()) == [("a", Decimal("1.50"), Decimal("0.00")),
                                                     ("b", Decimal("0.00"), Decimal("2.00"))]


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([(i, 10 if i < 4 else i) for i in range(1, 8)], "k int, v int")
    top = shape.top_k(df, 3, [F.desc("v"), F.asc("k")], "rank").collect()
    assert [(r.k, r.rank) for r in top] == [(1, 1), (2, 2), (3, 3)]
    top = shape.top_k(df.where("v = 10"), 2, [F.desc("v"), F.asc("k")], "rank").collect()
    assert [r.k for r in top] == [1, 2]


def test_best_by_tie_goes_to_earlier(spark):
    df = spark.createDataFrame([(1, "Jan", 5), (2, "Feb", 9), (3, "Mar", 9)], "month int, name string, v int")
    (r,) = shape.best_by(df, "v", "month", ["month", "name", "v"]).collect()
    assert (r.month, r.name) == (2, "Feb")


def test_share(spark):
    df = spark.createDataFrame([("A", Decimal("1")), ("B", Decimal("3"))], "t string, v decimal(38,2)")
    got = {r.t: r.share_pct for r in shape.share(df, "v").collect()}
    assert got == {"A": Decimal("25.0000"), "B": Decimal("75.0000")}
