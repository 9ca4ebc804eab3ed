"""Point-in-time join: each fact row meets the dimension version live at its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.functions import far_future
from weekly_mart.schemas import VALID_FROM, VALID_TO


def pit_condition(
    fact_alias: str,
    dim_alias: str,
    keys: list[str],
    ts_col: Column,
    boundary: str = "closed",
    valid_from: str = VALID_FROM,
    valid_to: str = VALID_TO,
) -> Column:
    """Equality on ``keys`` AND the validity interval, over two aliased inputs.

    ``closed``: ``ts BETWEEN from AND coalesce(to, 9999-12-31)`` (the
    reference's rule; a time equal to a version change matches both
    versions). ``half_open``: ``from <= ts < coalesce(to, 9999-12-31)``.
    A DATE is compared as midnight of that day.
    """
    ts = ts_col.cast("timestamp_ntz")
    start = F.col(f"{dim_alias}.{valid_from}")
    end = F.coalesce(F.col(f"{dim_alias}.{valid_to}"), far_future())
    if boundary == "closed":
        cond = ts.between(start, end)
    elif boundary == "half_open":
        cond = (ts >= start) & (ts < end)
    else:
        raise ValueError(f"unknown boundary {boundary!r}")
    for k in reversed(keys):
        cond = (F.col(f"{fact_alias}.{k}") == F.col(f"{dim_alias}.{k}")) & cond
    return cond


def pit_join(
    fact: DataFrame,
    dim: DataFrame,
    keys: list[str],
    ts_col: str,
    boundary: str = "closed",
    how: str = "inner",
) -> DataFrame:
    """Fact columns plus the non-key columns of the version live at ``ts_col``.

    An equi-join on the keys with the interval as a residual condition: Spark
    plans a hash join on the keys (broadcast when the dimension's statistics
    are under the threshold, otherwise a shuffle join that AQE splits on
    skewed keys). Versions per key are few and do not overlap, so no row is
    multiplied beyond the versions whose interval contains the time.
    """
    cond = pit_condition("_pf", "_pd", keys, F.col(f"_pf.{ts_col}"), boundary)
    dim_cols = [c for c in dim.columns if c not in keys and c not in fact.columns]
    return fact.alias("_pf").join(dim.alias("_pd"), cond, how).select(
        *[F.col(f"_pf.{c}") for c in fact.columns], *[F.col(f"_pd.{c}") for c in dim_cols]
    )


#: A level's bins are this many times as wide as those of the level below.
LEVEL_STEP = 4
#: Levels at most; the bins of the last one are wider than the calendar.
LEVELS = 12


def _width(level: Column, bin_days: int) -> Column:
    return F.lit(bin_days).cast("long") * F.pow(F.lit(LEVEL_STEP), level).cast("long")


def _bin(ts: Column, level: Column, bin_days: int) -> Column:
    return F.floor(F.unix_date(ts.cast("date")) / _width(level, bin_days))


def same_bin(fact_alias: str, dim_alias: str, ts_col: Column, bin_days: int) -> Column:
    level = F.col(f"{fact_alias}._level")
    return (F.col(f"{dim_alias}._level") == level) & (F.col(f"{dim_alias}._bin") == _bin(ts_col, level, bin_days))


def binned(
    fact: DataFrame, dim: DataFrame, ts_col: str, bin_days: int, valid_from: str = VALID_FROM, valid_to: str = VALID_TO
) -> tuple[DataFrame, DataFrame]:
    """Both sides of a point-in-time join by calendar bins: facts with ``_level``, versions with ``_level`` and ``_bin``.

    A version is cut to the first and last time of ``fact`` and goes to the
    level whose bins are as long as it or longer, so it reaches into two bins at
    most however long it is open. A fact is repeated for each level that some
    version has (a few numbers; levels grow by ``LEVEL_STEP``), where it is in
    one bin, so it meets each version once at most. The versions are marked to be
    joined by sort-merge: the planner can't tell how many they are.
    """
    first, last = fact.agg(F.min(ts_col).cast("date"), F.max(ts_col).cast("date")).first()
    low = F.greatest(F.col(valid_from).cast("date"), F.lit(first))
    high = F.least(F.coalesce(F.col(valid_to), far_future()).cast("date"), F.lit(last))
    days = F.datediff(high, low) + 1
    level = F.lit(LEVELS)
    for n in reversed(range(LEVELS)):
        level = F.when(days <= bin_days * LEVEL_STEP**n, n).otherwise(level)
    leveled = dim.where(low <= high).withColumn("_level", level)
    levels = sorted(r["_level"] for r in leveled.select("_level").distinct().collect())
    spread = leveled.withColumn(
        "_bin", F.explode(F.sequence(_bin(low, F.col("_level"), bin_days), _bin(high, F.col("_level"), bin_days)))
    )
    repeated = fact.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels]).cast("array<int>")))
    return repeated, spread.hint("merge")


def pit_join_binned(
    fact: DataFrame, dim: DataFrame, keys: list[str], ts_col: str, boundary: str = "closed", bin_days: int = 28
) -> DataFrame:
    """`pit_join` (inner) for keys with very many versions.

    The plain join compares every row of a key with all versions of the key.
    Here both sides meet on (keys, level, calendar bin), so a row is compared
    only with the versions of its bins, and the hash spreads one key over its
    bins. ``bin_days``, the width of the finest bins, should be near the length
    of the shortest usual versions; longer ones have wider bins (`binned`).
    """
    rows, spread = binned(fact, dim, ts_col, bin_days)
    ts = F.col(f"_pf.{ts_col}")
    cond = pit_condition("_pf", "_pd", keys, ts, boundary) & same_bin("_pf", "_pd", ts, bin_days)
    dim_cols = [c for c in dim.columns if c not in keys and c not in fact.columns]
    return rows.alias("_pf").join(spread.alias("_pd"), cond).select(
        *[F.col(f"_pf.{c}") for c in fact.columns], *[F.col(f"_pd.{c}") for c in dim_cols]
    )
