"""Tables kept by sale year: only years whose inputs changed are built again, all of them in one job."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def refresh(ws, target: str, marks: dict[int, str], build: Callable[[list[int]], DataFrame]) -> DataFrame:
    """The table under ``target``, partitioned by ``sale_year``, brought up to ``marks``.

    A year's part is ``sale_year=<year>/build=<mark>``, where the mark is a digest
    of what the year is made from. ``build(years)`` gives the rows, with
    ``sale_year``, of the years that have no finished part; they are written by
    one job with dynamic partition overwrite, so what a dead run left of them is
    replaced. Parts of earlier marks stay for readers that opened them.
    """
    part = lambda y: f"{target}/sale_year={y}/build={marks[y]}"
    missing = [y for y in sorted(marks) if not ws.exists(f"{part(y)}/_SUCCESS")]
    if not marks:
        return build([])
    schema = build(missing or sorted(marks)[:1]).schema
    if missing:
        mark_of = F.create_map(*[F.lit(x) for y in missing for x in (y, marks[y])])
        rows = build(missing).withColumn("build", F.element_at(mark_of, F.col("sale_year")))
        (
            rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
            .partitionBy("sale_year", "build").parquet(target)
        )
        for y in missing:
            ws.mark(f"{part(y)}/_SUCCESS")
    columns = [f for f in schema.fields if f.name != "sale_year"]
    kind = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in columns], "sale_year int", "build string"])
    found = ws.spark.read.schema(kind).option("basePath", target).parquet(*[part(y) for y in sorted(marks)])
    return found.drop("build")
