"""Dimensions: date dimension (rebuild and SCD1 upsert), SCD2 snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weekly_mart.functions import audit_ts, ts_literal
from weekly_mart.operators.shape import number_in_order
from weekly_mart.schemas import VALID_FROM, VALID_TO

# Parts that the department list is dealt over.
DEPARTMENT_CHUNKS = 64


# --------------------------------------------------------------------------
# Date dimension
# --------------------------------------------------------------------------
def date_dim(stg_fact: DataFrame, as_of: str | None = None) -> DataFrame:
    """One row per distinct (store_date, is_holiday) with a dense surrogate id.

    The distinct runs first (partial aggregation on every partition), so the
    numbering window only sees the distinct dates: at most two rows per
    calendar day, bounded by the calendar and not by the data volume.
    Ids follow (store_date, is_holiday) so they are stable under re-runs.
    """
    ts = audit_ts(as_of)
    pairs = stg_fact.select("store_date", "is_holiday").distinct()
    return pairs.select(
        F.row_number().over(Window.orderBy("store_date", "is_holiday")).alias("date_id"),
        "store_date",
        "is_holiday",
        ts.alias("insert_date"),
        ts.alias("update_date"),
    )


def date_increment(stg_fact: DataFrame) -> DataFrame:
    """Distinct dates with one holiday flag each (holiday if any store says so)."""
    return stg_fact.groupBy("store_date").agg(F.max("is_holiday").alias("is_holiday"))


def scd1_upsert(
    dim: DataFrame,
    incoming: DataFrame,
    key: str = "store_date",
    id_col: str = "date_id",
    value_cols: tuple[str, ...] = ("is_holiday",),
    as_of: str | None = None,
    cut: Column | None = None,
) -> DataFrame:
    """Type-1 upsert: overwrite values in place, keep ids and insert_date.

    Existing keys keep their id and insert_date; update_date moves only when a
    value changed. New keys get ids after the current maximum, numbered in key
    order. ``incoming`` must hold one row per key. One full outer join on the
    key; the id offset is a one-row scalar subquery. New keys are numbered by
    stretches of their order (``cut``; months, where the key is a date).
    """
    ts = audit_ts(as_of)
    one_per_key = (
        incoming.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in value_cols])
        .select(
            key, *value_cols,
            F.when(F.col("_n") == 1, F.lit(True))
            .otherwise(F.raise_error(F.lit("upsert input has duplicate keys"))).alias("_in"),
        )
    )
    d, i = dim.alias("d"), one_per_key.alias("i")
    j = d.join(i, F.col(f"d.{key}") == F.col(f"i.{key}"), "full")
    is_new = F.col(f"d.{id_col}").isNull()
    changed = F.lit(False)
    for c in value_cols:
        changed = changed | ~F.col(f"d.{c}").eqNullSafe(F.col(f"i.{c}"))
    present = F.col("i._in").isNotNull()

    max_id = dim.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("m")).scalar()
    cols = [
        F.coalesce(F.col(f"d.{key}"), F.col(f"i.{key}")).alias(key),
        *[F.when(present, F.col(f"i.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in value_cols],
        F.when(is_new, ts).otherwise(F.col("d.insert_date")).alias("insert_date"),
        F.when(is_new | (present & changed), ts).otherwise(F.col("d.update_date")).alias("update_date"),
    ]
    # Existing rows keep their id with no window at all; only the new keys are numbered.
    kept = j.where(~is_new).select(F.col(f"d.{id_col}").alias(id_col), *cols)
    added = number_in_order(j.where(is_new).select(*cols), [key], cut if cut is not None else F.trunc(key, "month"), "_no")
    added = added.select((max_id + F.col("_no")).cast("int").alias(id_col), key, *value_cols,
                         "insert_date", "update_date")
    return kept.unionByName(added)


# --------------------------------------------------------------------------
# Store dimension (SCD2)
# --------------------------------------------------------------------------
def store_dim_source(stg_stores: DataFrame, stg_department: DataFrame) -> DataFrame:
    """Every store x every department that has sales: the dimension's grain.

    ``stg_department`` is the sales (or an already distinct department list).

    The department list is a distinct over the sales (partial aggregation). It
    is dealt by hash over a fixed number of chunks, and every store meets every
    chunk by its number, so no task holds the whole list.
    """
    chunks = (
        stg_department.where("dept_id IS NOT NULL").select("dept_id").distinct()
        .groupBy(F.pmod(F.xxhash64("dept_id"), F.lit(DEPARTMENT_CHUNKS)).cast("int").alias("chunk"))
        .agg(F.collect_list("dept_id").alias("ids"))
    )
    stores = stg_stores.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(DEPARTMENT_CHUNKS - 1))))
    return stores.join(chunks, "chunk").select(
        "store_id", F.explode("ids").alias("dept_id"), "store_type", "store_size"
    )


def snapshot(
    dim: DataFrame | None,
    source: DataFrame,
    keys: list[str],
    check_cols: list[str],
    as_of: str,
    invalidate_hard_deletes: bool = True,
    initial_valid_from: str | None = None,
) -> DataFrame:
    """Check-strategy SCD2 snapshot; returns the whole new dimension.

    - new key: open version from ``as_of`` (``initial_valid_from`` backdates
      the very first load so older facts find a version);
    - changed check column (NULL-safe compare): close the open version at
      ``as_of`` and open a new one;
    - unchanged: keep;
    - key gone: close it (``invalidate_hard_deletes``); if it comes back later
      it opens a new version;
    - closed history passes through untouched.

    Open versions meet the source in ONE full outer join on the keys; each
    joined row emits <= 2 versions through explode(filter(array(...))).
    The caller writes the result as a new version of the table.
    """
    ts = ts_literal(as_of)
    payload = [c for c in source.columns if c not in keys]
    # One row per key or the job fails (duplicates would multiply versions).
    # The aggregation hash-partitions on the keys, which the join below
    # reuses: the check adds no shuffle.
    src = (
        source.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in payload])
        .select(
            *keys, *payload,
            F.when(F.col("_n") == 1, F.lit(True))
            .otherwise(F.raise_error(F.lit("snapshot source has duplicate keys")))
            .alias("_src"),
        )
    )
    if dim is None:
        start = ts_literal(initial_valid_from) if initial_valid_from else ts
        return src.where(F.col("_src")).select(
            *keys, *payload,
            start.alias(VALID_FROM),
            F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
            ts.alias("insert_date"),
            ts.alias("update_date"),
        )

    cols = [*keys, *payload, VALID_FROM, VALID_TO, "insert_date", "update_date"]
    history = dim.where(F.col(VALID_TO).isNotNull()).select(*cols)
    live = dim.where(F.col(VALID_TO).isNull()).select(*cols).withColumn("_dim", F.lit(True))

    o, s = live.alias("o"), src.alias("s")
    cond = [F.col(f"o.{k}") == F.col(f"s.{k}") for k in keys]
    j = o.join(s, cond, "full")

    in_dim, in_src = F.col("o._dim").isNotNull(), F.col("s._src").isNotNull()
    changed = F.lit(False)
    for c in check_cols:
        changed = changed | ~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}"))
    close = in_dim & ((in_src & changed) | (~in_src & F.lit(invalidate_hard_deletes)))
    open_new = in_src & (~in_dim | changed)

    old_v = F.struct(
        *[F.col(f"o.{c}").alias(c) for c in keys + payload + [VALID_FROM]],
        F.when(close, ts).otherwise(F.col(f"o.{VALID_TO}")).alias(VALID_TO),
        F.col("o.insert_date").alias("insert_date"),
        F.when(close, ts).otherwise(F.col("o.update_date")).alias("update_date"),
    )
    new_v = F.struct(
        *[F.col(f"s.{c}").alias(c) for c in keys + payload],
        ts.alias(VALID_FROM),
        F.lit(None).cast("timestamp_ntz").alias(VALID_TO),
        ts.alias("insert_date"),
        ts.alias("update_date"),
    )
    versions = F.array(
        F.when(in_dim, old_v), F.when(open_new, new_v)
    )
    emitted = j.select(F.explode(F.filter(versions, lambda v: v.isNotNull())).alias("v")).select("v.*")
    return history.unionByName(emitted)


def run_snapshot(
    ws,
    target: str,
    source: DataFrame,
    keys: list[str],
    check_cols: list[str],
    as_of: str,
    invalidate_hard_deletes: bool = True,
    initial_valid_from: str | None = None,
) -> DataFrame:
    """Apply one snapshot run to the dimension stored at ``target``.

    Reads the newest complete version (if any) and writes a new one beside it,
    so a run that dies at any point leaves the history as it was.
    """
    current = ws.read(target) if ws.is_complete(target) else None
    new = snapshot(current, source, keys, check_cols, as_of, invalidate_hard_deletes, initial_valid_from)
    ws.write(new, target)
    return ws.read(target)


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.col(VALID_TO).isNull())
