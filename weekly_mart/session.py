"""Session settings sized to the input.

The shuffle partition count follows the input volume (about one partition
per ``target_bytes`` of input, which AQE then coalesces or splits at run time),
so a 100 TB run gets tens of thousands of partitions of a size that fits
executor memory, while a small run is not spread over idle tasks. Settings
the submitter set explicitly are left alone.
"""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

MB = 1024 * 1024
#: A join side of at most this many bytes, by file or shuffle statistics, is broadcast.
BROADCAST_BYTES = 64 * MB


def input_bytes(spark: SparkSession, *paths: str) -> int:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        jp = jvm.org.apache.hadoop.fs.Path(p)
        total += int(jp.getFileSystem(conf).getContentSummary(jp).getLength())
    return total


def _explicit(spark: SparkSession, key: str) -> bool:
    return spark.sparkContext.getConf().contains(key)


def size_for_input(
    spark: SparkSession, nbytes: int, target_bytes: int = 256 * MB, lo: int = 8, hi: int = 200_000
) -> dict[str, str]:
    """Apply (and return) the sized settings that the submitter did not set."""
    parts = max(lo, min(hi, math.ceil(nbytes / target_bytes)))
    settings = {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(BROADCAST_BYTES),
    }
    applied = {k: v for k, v in settings.items() if not _explicit(spark, k)}
    for k, v in applied.items():
        spark.conf.set(k, v)
    return applied
