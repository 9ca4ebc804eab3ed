"""SCD2 snapshot kept in key buckets: a run joins and writes only buckets whose source rows changed.

``live`` has one partition for each bucket of keys; ``closed`` has one for each
run and bucket, written once. A bucket's source and live rows are compared by
digests, combined before the shuffle, so a run over an unchanged source reads
both and writes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.operators.dims import snapshot
from weekly_mart.schemas import VALID_TO

BUCKETS = 64


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _digests(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    row = F.xxhash64(*columns)
    return df.groupBy("bucket").agg(
        F.struct(F.count(F.lit(1)), F.bit_xor(row), F.sum(row % 1_000_003)).alias(name)
    )


def _live(ws, target: str, schema: str) -> DataFrame:
    return ws.spark.read.schema(f"{schema}, _row boolean, bucket int").parquet(f"{target}/live").where("_row").drop("_row")


def refresh_snapshot(
    ws, target: str, source: DataFrame, keys: list[str], check_cols: list[str], as_of: str, run: str,
    invalidate_hard_deletes: bool = True, initial_valid_from: str | None = None, buckets: int = BUCKETS,
) -> list[int]:
    """Apply one snapshot run, named ``run``, to the dimension at ``target``; returns the buckets it rewrote.

    The changed buckets' versions are worked out once and staged; what the run
    closed is written first, then the live partitions are overwritten. A run that
    dies is repeated under its name: buckets it had finished no longer differ,
    the others are written again over what is there of them. Only bucket numbers
    come to the driver.
    """
    source = source.withColumn("bucket", _bucket(keys, buckets))
    first = not ws.exists(f"{target}/columns")
    if first:
        changed = list(range(buckets))
        new = snapshot(None, source.drop("bucket"), keys, check_cols, as_of, invalidate_hard_deletes, initial_valid_from)
    else:
        live = _live(ws, target, _schema(ws, target))
        compared = [*keys, *check_cols]
        pairs = _digests(source, compared, "s").join(_digests(live, compared, "l"), "bucket", "full")
        changed = sorted(r.bucket for r in pairs.where(~F.col("s").eqNullSafe(F.col("l"))).select("bucket").collect())
        if not changed:
            return []
        mine = F.col("bucket").isin(changed)
        new = snapshot(
            live.where(mine).drop("bucket"), source.where(mine).drop("bucket"), keys, check_cols, as_of, invalidate_hard_deletes
        )
    ws.write(new.withColumn("bucket", _bucket(keys, buckets)), f"{target}/staged")
    staged = ws.read(f"{target}/staged")
    closed = staged.where(F.col(VALID_TO).isNotNull()).withColumn("run", F.lit(run))
    _overwrite(closed, f"{target}/closed", "run", "bucket")
    # one more row for each bucket, so that one that has no live version left is overwritten too
    held = ws.spark.range(1).select(F.explode(F.lit(changed)).alias("bucket"), F.lit(False).alias("_row"))
    rows = staged.where(F.col(VALID_TO).isNull()).withColumn("_row", F.lit(True))
    _overwrite(rows.unionByName(held, allowMissingColumns=True), f"{target}/live", "bucket")
    if first:  # from here on there is a dimension to compare with
        ws.put_text(f"{target}/columns", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema))
    return changed


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    writer = df.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*by).parquet(path)


def _schema(ws, target: str) -> str:
    return ws.get_text(f"{target}/columns")


def read_snapshot(ws, target: str) -> DataFrame:
    """All versions: the live ones and those that runs closed."""
    schema = _schema(ws, target)
    closed = ws.spark.read.schema(f"{schema}, run string, bucket int").parquet(f"{target}/closed").drop("run", "bucket")
    return _live(ws, target, schema).drop("bucket").unionByName(closed)
