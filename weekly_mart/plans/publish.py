"""Report runs and report outputs.

``run_report`` returns a report with its row count observed during the
write (``df.observe``: the count is a by-product of the same job, no second
pass). ``publish`` writes every report and report data set to
``{out}/<name>``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from weekly_mart.plans import datasets, reports
from weekly_mart.plans.pipeline import Mart


def run_report(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def publish(m: Mart, out: str | None = None, fmt: str = "parquet") -> dict[str, int]:
    """Write all report outputs; returns {name: rows}."""
    out = out or f"{m.base}/reports"
    g = m.gold()
    opts = {"header": "true"} if fmt == "csv" else {}

    def one(name, fn):
        df, obs = run_report(fn(g), name)
        df.write.format(fmt).mode("overwrite").options(**opts).save(f"{out}/{name}")
        return name, obs.get["rows"]

    # The outputs are independent small jobs: write them a few at a time.
    items = list({**reports.REPORTS, **datasets.DATASETS}.items())
    counts: dict[str, int] = {}
    for i in range(0, len(items), 8):
        counts.update(m._together(*[lambda n=n, f=f: one(n, f) for n, f in items[i:i + 8]]))
    return counts
