"""Incremental Bronze load: add each new landing file exactly once.

A Structured Streaming file source over the landing folder with
``trigger(availableNow=True)``: every run processes the files that arrived
since the last run (tracked in the checkpoint), appends them to the Bronze
parquet folder with exactly-once file commits, and stops. A second run with
no new files adds nothing. Same strict CSV options as the batch loader.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from weekly_mart.schemas import RAW_SCHEMAS
from weekly_mart.sources.landing import NULL_TOKEN


def load_new_files(
    spark: SparkSession, landing: str, table: str, bronze_path: str, checkpoint: str,
    folder: str | None = None, max_files_per_trigger: int | None = None,
) -> int:
    """Run one availableNow pass; returns the number of micro-batches run.

    Reads ``{landing}/{folder or table}/``, or ``landing`` itself where
    ``folder`` is empty. For files that are uploaded again under their name, use
    `weekly_mart.streaming.uploads`.
    """
    reader = (
        spark.readStream.schema(RAW_SCHEMAS[table])
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("nullValue", NULL_TOKEN)
        .option("mode", "FAILFAST")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    source = landing.rstrip("/") if folder == "" else f"{landing.rstrip('/')}/{folder or table}/"
    stream = reader.csv(source)
    query = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(bronze_path)
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return len(query.recentProgress)
