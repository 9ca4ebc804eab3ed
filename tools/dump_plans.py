"""Write PLANS.md: physical plans (final adaptive plans where the query was run)
of the pipeline's key jobs at one scale.

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plan(df, run: bool) -> str:
    if run:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    text = re.sub(r"file:/\S+?/weekly_mart/[0-9a-f]+/", "<ws>/", text)
    text = re.sub(r"#\d+L?", "", text)
    return text.strip()


def main():
    from pyspark.sql import SparkSession

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false")
             .config("spark.ui.enabled", "false")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-plans-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from weekly_mart.operators import dims, fact
    from weekly_mart.plans import datasets, reports, summaries
    from weekly_mart.plans.pipeline import mart
    from weekly_mart.schemas import STORE_DIM_CHECK, STORE_DIM_KEYS

    m = mart(spark, sf)
    g = m.gold()
    items = [
        ("Fact build (sales x date dim x store version x store-week)", False,
         fact.build_fact(m.stg_department(), m.store_dim(), m.stg_fact(), m.date_dim(), as_of="2000-01-01 00:00:00")),
        ("SCD2 snapshot, second run", False,
         dims.snapshot(m.store_dim_initial(), m.store_dim_source(1), STORE_DIM_KEYS, STORE_DIM_CHECK,
                       as_of="1998-07-03 00:00:00")),
        ("Date dimension", True, dims.date_dim(m.stg_fact(), as_of="2000-01-01 00:00:00")),
        ("Summary sales_versioned (the one point-in-time join the reports need)", False,
         summaries.sales_versioned(g.fact, g.date_dim, g.store_dim)),
        ("Report r2 (flagship)", True, reports.r2(g)),
        ("Report r10 (reads the fact)", True, reports.r10(g)),
        ("Data set report1_grid (dense store x holiday grid)", True, datasets.report1_grid(g)),
        ("Data set report7_top15 (pivot + top 15)", True, datasets.report7_top15(g)),
        ("Data tests", True, m.dq_results()),
    ]
    out = [f"# Physical plans at {os.path.basename(sf)} (local[8], AQE on)\n",
           "Generated by `tools/dump_plans.py`. Queries marked *final* were run first, so the plan is "
           "AQE's final plan; build plans are the initial plans.\n"]
    for title, run, df in items:
        out.append(f"## {title}{' — final' if run else ''}\n\n```\n{plan(df, run)}\n```\n")
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))


if __name__ == "__main__":
    main()
