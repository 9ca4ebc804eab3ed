"""Data tests. Each returns rows (test, table_name, column_name, failures).

All null / sign tests of one table run as ONE aggregation pass; a uniqueness
test is one grouped aggregation on its key. Nothing is collected: callers
decide whether any ``failures > 0`` should stop a run (``assert_clean``).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from weekly_mart.operators.pit import pit_condition
from weekly_mart.schemas import VALID_FROM, VALID_TO

OUT = ["test", "table_name", "column_name", "failures"]


def _rows(table: str, checks: list[tuple[str, str, F.Column]], df: DataFrame) -> DataFrame:
    """One aggregation computing every check, unpivoted to one row per check."""
    wide = df.agg(*[F.count_if(cond).cast("bigint").alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    stack = ", ".join(f"'{t}', '{c}', c{i}" for i, (t, c, _) in enumerate(checks))
    return wide.selectExpr(f"stack({len(checks)}, {stack}) as (test, column_name, failures)").select(
        "test", F.lit(table).alias("table_name"), "column_name", "failures"
    )


def column_tests(
    df: DataFrame, table: str, not_null: list[str] = (), positive: list[str] = ()
) -> DataFrame:
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null]
    checks += [("positive", c, F.col(c) < 0) for c in positive]
    return _rows(table, checks, df)


def unique(df: DataFrame, table: str, cols: list[str]) -> DataFrame:
    """Number of key values that occur more than once; a NULL key is the not-null test's."""
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])
    dup = df.where(filled).groupBy(*cols).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).cast("bigint").alias("failures")).select(
        F.lit("unique").alias("test"), F.lit(table).alias("table_name"),
        F.lit(",".join(cols)).alias("column_name"), "failures",
    )


def key_and_column_tests(
    df: DataFrame, table: str, keys: list[str], not_null: list[str] = (), positive: list[str] = ()
) -> DataFrame:
    """Uniqueness of each single-column key and all column tests, in one scan.

    One grouping set for each key and one for the whole table; the aggregate
    combines all of them before the shuffle. A NULL key is the not-null test's.
    """
    checks = [("not_null", c, F.col(c).isNull()) for c in not_null] + [("positive", c, F.col(c) < 0) for c in positive]
    # the columns that are tested under names of their own: grouping sets blank out the keys
    rows = df.select(*keys, *[cond.alias(f"c{i}") for i, (_, _, cond) in enumerate(checks)])
    sets = rows.groupingSets([[F.col(k)] for k in keys] + [[]], *keys).agg(
        F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), *[F.count_if(f"c{i}").alias(f"f{i}") for i in range(len(checks))]
    )
    every = (1 << len(keys)) - 1
    gid = {k: every ^ (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    twice = [F.count_if((F.col("gid") == gid[k]) & F.col(k).isNotNull() & (F.col("n") > 1)) for k in keys]
    whole = [F.coalesce(F.max(F.when(F.col("gid") == every, F.col(f"f{i}"))), F.lit(0)) for i in range(len(checks))]
    names = [("unique", k) for k in keys] + [(t, c) for t, c, _ in checks]
    wide = sets.agg(*[x.cast("bigint").alias(f"t{i}") for i, x in enumerate([*twice, *whole])])
    return _unpivoted(wide, table, names)


def _unpivoted(wide: DataFrame, table: str, names: list[tuple[str, str]]) -> DataFrame:
    stack = ", ".join(f"'{t}', '{c}', t{i}" for i, (t, c) in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (test, column_name, failures)").select(
        "test", F.lit(table).alias("table_name"), "column_name", "failures"
    )


def scd2_tests(dim: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """At most one open version per key; versions of a key do not overlap. One scan, one shuffle on the keys.

    The window is per key, whose rows are the key's few versions."""
    w = Window.partitionBy(*keys).orderBy(VALID_FROM)
    prev_end = F.lag(F.coalesce(F.col(VALID_TO), F.lit("9999-12-31").cast("timestamp_ntz"))).over(w)
    filled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    by_key = (
        dim.select(*keys, F.col(VALID_TO).isNull().alias("_open"), (prev_end > F.col(VALID_FROM)).alias("_ov"))
        .groupBy(*keys).agg(F.count_if("_open").alias("opens"), F.count_if("_ov").alias("overlaps"))
    )
    wide = by_key.agg(
        F.count_if(filled & (F.col("opens") > 1)).cast("bigint").alias("t0"),
        F.coalesce(F.sum("overlaps"), F.lit(0)).cast("bigint").alias("t1"),
    )
    columns = ",".join(keys)
    return _unpivoted(wide, table, [("one_open_version", columns), ("no_overlap", columns)])


def run_all(date_dim: DataFrame, store_dim: DataFrame, fact: DataFrame) -> DataFrame:
    """All data tests; each table is scanned once."""
    parts = [
        key_and_column_tests(date_dim, "date_dim", ["date_id", "store_date"], not_null=["date_id", "store_date"]),
        column_tests(fact, "fact", not_null=["store_id", "dept_id", "store_weekly_sales"],
                     positive=["store_weekly_sales"]),
        scd2_tests(store_dim, "store_dim", ["store_id", "dept_id"]),
    ]
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: dict[str, DataFrame | int], expected: dict[str, int] | None = None) -> DataFrame:
    """(table_name, rows) for each table: a count that was taken when it was written, or else one aggregation.

    With ``expected`` (a load's known counts) adds ``expected`` and ``ok``."""
    known = [F.struct(F.lit(name).alias("table_name"), F.lit(n).cast("bigint").alias("rows"))
             for name, n in tables.items() if isinstance(n, int)]
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")).select(
        F.lit(name).alias("table_name"), "rows") for name, df in tables.items() if not isinstance(df, int)]
    if known:
        spark = SparkSession.getActiveSession()
        parts.append(spark.range(1).select(F.explode(F.array(*known)).alias("t")).select("t.*"))
    out = reduce(DataFrame.unionByName, parts)
    if expected is not None:
        exp = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.lit(int(v)))])
        out = out.withColumn("expected", F.element_at(exp, F.col("table_name")).cast("bigint")).withColumn(
            "ok", F.col("expected").isNull() | (F.col("expected") == F.col("rows"))
        )
    return out


def dropped_sales(
    raw_department: DataFrame, store_dim: DataFrame, stg_fact: DataFrame, date_dim: DataFrame, boundary: str = "closed",
) -> DataFrame:
    """(reason, rows): sales rows that are in no fact row, under the first reason that holds.

    The sales are read once and grouped by their grain; each group learns
    whether it meets a date, a store version and a store week.
    """
    amount, grain = F.col("weekly_sales").isNotNull(), ["store_id", "dept_id", "store_date"]
    typed = raw_department.select(
        amount.alias("amount"), F.when(amount, F.col("store").cast("int")).alias("store_id"),
        F.when(amount, F.col("dept").cast("int")).alias("dept_id"), F.when(amount, F.col("date").cast("date")).alias("store_date"),
    )
    sales = typed.groupBy("amount", *grain).agg(F.count(F.lit(1)).alias("n")).alias("s")
    hit = F.lit(True)
    dated = date_dim.select(F.col("store_date").alias("_date"), hit.alias("in_dates")).distinct()
    weeks = stg_fact.select(F.col("store_id").alias("_store"), F.col("store_date").alias("_week"), hit.alias("in_weeks")).distinct()
    versions = store_dim.select("store_id", "dept_id", VALID_FROM, VALID_TO, hit.alias("in_versions")).alias("v")
    live = pit_condition("s", "v", ["store_id", "dept_id"], F.col("s.store_date"), boundary)
    met = (
        sales.join(versions, live, "left")
        .groupBy("s.amount", *[f"s.{c}" for c in grain])  # a time on a boundary meets two versions
        .agg(F.max("n").alias("n"), F.max("in_versions").alias("in_versions"))
        .join(dated, F.col("store_date") == F.col("_date"), "left")
        .join(weeks, (F.col("store_id") == F.col("_store")) & (F.col("store_date") == F.col("_week")), "left")
    )
    reasons = {
        "no_amount": ~F.col("amount"), "no_date": F.col("in_dates").isNull(),
        "no_store_version": F.col("in_versions").isNull(), "no_store_week": F.col("in_weeks").isNull(),
    }
    first, before = {}, F.lit(False)
    for name, holds in reasons.items():
        first[name], before = ~before & holds, before | holds
    wide = met.agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("bigint").alias(name) for name, c in first.items()])
    stack = ", ".join(f"'{name}', {name}" for name in first)
    return wide.selectExpr(f"stack({len(first)}, {stack}) as (reason, rows)")


def assert_clean(results: DataFrame, allow: tuple[str, ...] = ("positive",)) -> None:
    """Fail if any test outside ``allow`` has failures (one small action)."""
    bad = results.where((F.col("failures") > 0) & ~F.col("test").isin(*allow)).collect()
    if bad:
        raise AssertionError(f"data tests failed: {[r.asDict() for r in bad]}")
