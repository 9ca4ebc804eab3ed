"""Run the whole pipeline: landing -> Bronze -> Silver -> Gold -> data tests -> reports.

    python -m weekly_mart --sf /root/testdata/sf0.1 [--out DIR] [--format parquet|csv]
    python -m weekly_mart --landing DIR [--upload stores=stores.csv fact=fact.csv department=department.csv]

The Spark master and resources come from the submitting environment; the
workspace is the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from weekly_mart.operators import quality
from weekly_mart.plans.pipeline import CsvMart, Mart
from weekly_mart.sources.landing import upload
from weekly_mart.plans.publish import publish
from weekly_mart.session import input_bytes, size_for_input


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="weekly_mart")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf", help="folder with the driver's test tables (raw files are derived)")
    src.add_argument("--landing", help="landing folder with stores/ fact/ department/ CSV files")
    ap.add_argument("--upload", nargs="*", default=[], metavar="TABLE=PATH",
                    help="copy local CSV files into the landing folder first")
    ap.add_argument("--as-of", default=None, help="run time for snapshots and audit columns")
    ap.add_argument("--out", default=None, help="report output folder (default: workspace/reports)")
    ap.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--strict", action="store_true", help="fail when a data test or a row count fails")
    ap.add_argument("--expect", nargs="*", default=[], metavar="TABLE=ROWS",
                    help="expected row counts after load, e.g. department_raw=421570")
    args = ap.parse_args(argv)

    spark = (
        SparkSession.builder.appName("weekly_mart")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    t0 = time.time()
    if args.landing:
        if args.upload:
            upload(spark, dict(u.split("=", 1) for u in args.upload), args.landing)
        size_for_input(spark, input_bytes(spark, args.landing))
        m = CsvMart(spark, args.landing, as_of=args.as_of)
    else:
        size_for_input(spark, input_bytes(spark, f"{args.sf}/lineitem.parquet", f"{args.sf}/supplier.parquet"))
        m = Mart(spark, args.sf)
    m.build()
    dq = m.dq_results()
    expected = {k: int(v) for k, v in (e.split("=", 1) for e in args.expect)}
    counts_df = m.row_counts(expected) if expected else None
    if args.strict:
        quality.assert_clean(dq)
        if counts_df is not None:
            bad = counts_df.where("not ok").collect()
            if bad:
                raise AssertionError(f"row counts differ: {[r.asDict() for r in bad]}")
    counts = publish(m, args.out, args.format)
    print(json.dumps({
        "workspace": m.base,
        "data_tests": [r.asDict() for r in dq.collect()],
        "report_rows": counts,
        "row_counts": [r.asDict() for r in counts_df.collect()] if counts_df is not None else None,
        "seconds": round(time.time() - t0, 1),
    }))


if __name__ == "__main__":
    main()
