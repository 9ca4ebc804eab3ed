"""Shaping operators behind the charts: dense grids, pivots, top-k, shares, arg-max.

They run on aggregated report rows, but none of them pulls rows to the
driver or into one task: grids meet their columns by chunks, rows are numbered
by ranges, and totals are one-row scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Parts that the columns of a grid are dealt over.
GRID_CHUNKS = 16


def densify(df: DataFrame, row_key: str, col_key: str, value: str, fill=0) -> DataFrame:
    """Every (row_key, col_key) cell, missing cells = ``fill``; NULL is a key like any other.

    The distinct columns are dealt by hash over a fixed number of chunks; every
    row key meets every chunk by its number, and the grid meets the values by a
    null-safe equi-join. No bound on either list.
    """
    vtype = df.schema[value].dataType
    columns = (
        df.select(col_key).distinct()
        .groupBy(F.pmod(F.xxhash64(col_key), F.lit(GRID_CHUNKS)).cast("int").alias("_chunk"))
        .agg(F.collect_list(F.struct(col_key)).alias("_cols"))
    )
    rows = df.select(row_key).distinct().withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.lit(GRID_CHUNKS - 1)))
    )
    grid = rows.join(columns, "_chunk").select(
        F.col(row_key).alias("_row"), F.explode("_cols").alias("_cell")
    ).select("_row", F.col(f"_cell.{col_key}").alias("_col"))
    cells = df.groupBy(row_key, col_key).agg(F.any_value(value).alias(value))
    met = F.col("_row").eqNullSafe(F.col(row_key)) & F.col("_col").eqNullSafe(F.col(col_key))
    return grid.join(cells, met, "left").select(
        F.col("_row").alias(row_key),
        F.col("_col").alias(col_key),
        F.coalesce(F.col(value), F.lit(fill).cast(vtype)).alias(value),
    )


def pivot_sum(df: DataFrame, row_keys: list[str], pivot_col: str, values: list, value: str, fill=0) -> DataFrame:
    """Wide table: one column per given ``pivot_col`` value (named by the value),
    summed ``value``, empty cells = ``fill``. One aggregation, no job to find the values."""
    vtype = df.schema[value].dataType
    return df.groupBy(*row_keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col(pivot_col) == v, F.col(value))), F.lit(fill)).cast(vtype).alias(str(v))
            for v in values
        ]
    )


def number_in_order(df: DataFrame, order: list[str], bucket: Column, alias: str, group: list[str] = ()) -> DataFrame:
    """``alias`` = 1, 2, ... in the order of unique keys, within ``group`` if given.

    ``bucket`` cuts the order into stretches: a function of the first key that
    never falls as the key grows (a month, a magnitude). Each stretch is
    numbered on its own and shifted by the counts of the stretches before it,
    so a window sees one stretch, or one row per stretch, never a whole group.
    """
    cut = df.withColumn("_cut", bucket)
    sizes = cut.groupBy(*group, "_cut").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*group).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_cut").alias("_c"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    met = F.col("_cut").eqNullSafe(F.col("_c"))
    for g in group:
        met = met & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = Window.partitionBy(*group, "_cut").orderBy(*order)
    return (
        cut.withColumn("_pos", F.row_number().over(inside))
        .join(offsets, met, "left")
        .withColumn(alias, (F.col("_pos") + F.col("_before")).cast("int"))
        .select(*df.columns, alias)
    )


def magnitude(value: str) -> Column:
    """A cut for numbers: sixteen stretches for each doubling, on both sides of zero."""
    v = F.col(value).cast("double")
    return (F.signum(v) * F.floor(F.log2(1 + F.abs(v)) * 16)).cast("int")


def top_k(df: DataFrame, k: int, order: list[Column], rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows by ``order`` (give a unique tie-break last). Planned as
    a distributed take-ordered (per-partition top-k, then a k-row merge)."""
    top = df.orderBy(*order).limit(k)
    if rank_col:
        top = top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))
    return top


def share(df: DataFrame, value: str, alias: str = "share_pct", digits: int = 4) -> DataFrame:
    """``value / total * 100`` with the total as a one-row scalar subquery."""
    total = df.agg(F.sum(value).cast("double")).scalar()
    pct = F.round(F.try_divide(F.col(value).cast("double"), total) * 100, digits)
    return df.withColumn(alias, pct.cast(f"decimal({digits + 6},{digits})"))


def best_by(df: DataFrame, value: str, tie_asc: str, keep: list[str]) -> DataFrame:
    """The single row with the largest ``value``; ties go to the smallest ``tie_asc``."""
    picked = df.agg(
        F.max_by(F.struct(*keep), F.struct(F.col(value), -F.col(tie_asc))).alias("_best")
    )
    return picked.select("_best.*")
