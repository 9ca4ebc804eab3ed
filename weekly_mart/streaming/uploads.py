"""Incremental Bronze load of files that are uploaded again under their name.

A file stream knows files by path and never reads a replaced one. So the stream
here carries names, not rows: those of files it has not seen in the landing
folder, and those that `sources.landing.upload` announces (one small file for
each upload, always new). Every micro-batch reads the named files under the
strict rules and overwrites their partitions of the table, dynamically, so a
batch that is run again after a crash writes what it wrote before. The
checkpoint holds what was loaded; there is no log of our own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.schemas import RAW_SCHEMAS
from weekly_mart.sources.landing import arrivals_folder, read_files
from weekly_mart.sources.workspace import Workspace

_LISTING = "path string, modificationTime timestamp, length long, content binary"


def load_uploads(
    ws: Workspace, folder: str, table: str, target: str, max_files_per_trigger: int | None = None
) -> int:
    """Load what is new or announced in ``folder``; returns the number of files read.

    ``{target}/rows`` has one partition for each file name; a file uploaded again
    replaces its own, also where it has no rows any more. A file removed from the
    folder keeps its rows, as it does in a table that files are copied into. One
    malformed row fails the batch before anything of it is written, and the next
    run tries it again.
    """
    spark, folder = ws.spark, folder.rstrip("/")
    read = 0

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal read
        # the names of one batch, bounded by max_files_per_trigger; only files that are there still
        paths = [p for p in sorted({r["path"] for r in batch.collect()}) if ws.exists(p)]
        if not paths:
            return
        rows = read_files(spark, table, paths).withColumn("_file", F.col("_metadata.file_name"))
        # one more row for each file, so that a file without rows replaces its partition too
        held = batch.where(F.col("path").isin(paths)).select(F.element_at(F.split("path", "/"), -1).alias("_file")).distinct()
        marked = rows.withColumn("_row", F.lit(True)).unionByName(
            held.withColumn("_row", F.lit(False)), allowMissingColumns=True
        )
        (
            marked.withColumn("_batch", F.lit(batch_id)).write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("_file").parquet(f"{target}/rows")
        )
        read += len(paths)

    def stream(kind: str, schema: str, path: str):
        reader = spark.readStream.format(kind).schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.load(path)

    announced = arrivals_folder(folder)
    ws.make_folder(announced)
    seen = stream("binaryFile", _LISTING, folder).select("path")
    again = stream("text", "value string", announced).select(F.col("value").alias("path"))
    query = (
        seen.unionByName(again).writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return read


def read_uploads(ws: Workspace, target: str, table: str | None = None) -> DataFrame:
    """The loaded rows: of every file, those of its newest upload."""
    if not ws.exists(f"{target}/rows"):
        raise FileNotFoundError(f"nothing loaded into {target}")
    reader = ws.spark.read
    if table:
        names = [f"{f.name} string" for f in RAW_SCHEMAS[table]]
        reader = reader.schema(", ".join([*names, "_row boolean", "_batch long", "_file string"]))
    return reader.parquet(f"{target}/rows").where("_row").drop("_row", "_batch", "_file")
