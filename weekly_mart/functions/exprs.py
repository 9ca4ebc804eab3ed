"""Column expressions shared by the layers (all built-in, JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from weekly_mart.schemas import FAR_FUTURE, TEMP_BUCKET_ELSE, TEMP_BUCKETS


def ts_literal(value: str) -> Column:
    """A session-zone independent timestamp literal (TIMESTAMP_NTZ)."""
    return F.lit(value).cast("timestamp_ntz")


def far_future() -> Column:
    return ts_literal(FAR_FUTURE)


def audit_ts(as_of: str | None) -> Column:
    """Audit time: the given run time, or the wall clock of the query."""
    return F.localtimestamp() if as_of is None else ts_literal(as_of)


def temp_bucket(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for bound, label in TEMP_BUCKETS:
        expr = F.when(c < bound, label) if expr is None else expr.when(c < bound, label)
    return expr.otherwise(TEMP_BUCKET_ELSE)


def bucket_ord(col: str | Column) -> Column:
    """Position of the bucket in display order (0 = '< 0')."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for i, (bound, _) in enumerate(TEMP_BUCKETS):
        expr = F.when(c < bound, i) if expr is None else expr.when(c < bound, i)
    return expr.otherwise(len(TEMP_BUCKETS))


def month_name(col: str | Column) -> Column:
    """Full month name ('February'), the order the charts use."""
    return F.date_format(col, "MMMM")
