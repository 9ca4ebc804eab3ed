from weekly_mart.functions.exprs import (  # noqa: F401
    audit_ts,
    bucket_ord,
    far_future,
    month_name,
    temp_bucket,
    ts_literal,
)
