"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows and bytes of a batch that goes to a Python worker. Worker and executor keep the memory that their largest batch took.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 4 << 20}


def bound_batches(spark: SparkSession) -> None:
    """Limit the session's batches; a lower limit that it has already stays."""
    for name, most in BATCH_LIMITS.items():
        now = spark.conf.get(name, None)
        if not (now and now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, str(most))


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``, or a
    folder of the warehouse where that is unset. A warehouse on machine-local
    disks will do for local runs only; on a cluster it raises."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = warehouse.startswith(("file:", "/"))
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return warehouse.rstrip("/") + "/_checkpoint"


_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def materialise(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder of the shared scratch space and read it back.

    Cuts lineage: a lost executor recomputes from the written files, never from
    the plan above them. So the shuffle files of a finished job are of no further
    use, and Spark is told, for the session, to remove them with the job.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    if spark.conf.get(SHUFFLE_CLEANUP, None) != "true":
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    df.write.parquet(path, compression=compression)
    written = spark.read.schema(df.schema).parquet(path)
    _folders[written] = path
    return written


def forget(*written: DataFrame) -> None:
    """Remove the folders of tables that `materialise` wrote and nothing reads any more."""
    for df in written:
        jvm, path = df.sparkSession._jvm, _folders.pop(df)
        folder = jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


#: Rows and bits of a membership filter, whatever the number of its keys.
FILTER_ROWS, FILTER_WORD = 1 << 17, 64


def _filter_place(cols: tuple[str, ...]) -> tuple[Column, Column]:
    h = F.xxhash64(F.lit("filter"), *cols)
    return F.pmod(h, F.lit(FILTER_ROWS)), F.pmod(F.shiftright(h, 32), F.lit(FILTER_WORD)).cast("int")


def membership(keys: DataFrame, *cols: str) -> DataFrame:
    """A filter that holds the keys: at most ``FILTER_ROWS`` rows of 64 bits, so it can be sent to all executors."""
    row, bit = _filter_place(cols)
    marked = keys.select(row.alias("_row"), F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("_bit"))
    return materialise(marked.groupBy("_row").agg(F.bit_or("_bit").alias("_bits")), "filter")


def maybe_in(df: DataFrame, held: DataFrame, *cols: str, flag: str) -> DataFrame:
    """``df`` with a flag that is false only where the key is surely none of the filter's.

    The more keys the filter holds, the more other rows it flags; what is done
    with flagged rows has to be right for them too.
    """
    row, bit = _filter_place(cols)
    hit = F.coalesce(F.getbit("_bits", bit) == 1, F.lit(False))
    return df.join(F.broadcast(held), row == F.col("_row"), "left").select(*df.columns, hit.alias(flag))


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns in one, ``row``, so that no helper column can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def unpacked(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col("row").getField(c).alias(c) for c in columns])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(values: Column, zero: Column, join, block: int = 64) -> Column:
    """Array whose entry i joins entries 0 to i of ``values``; ``join`` has to be associative, ``zero`` neutral.

    Totals of blocks, and of blocks of blocks, stand in for what lies before an
    entry's own block, so no list is built entry by entry.
    """

    def total(c: Column, first: Column, end: Column) -> Column:
        return F.aggregate(F.slice(c, first + 1, end - first), zero, join)

    def totals(c: Column) -> Column:
        blocks = F.floor((F.size(c) + block - 1) / block).cast("int")
        numbers = F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda k: total(c, k * block, F.least((k + 1) * block, F.size(c))))

    def entries(c: Column, one: Column, two: Column) -> Column:
        def entry(x: Column, i: Column) -> Column:
            low = F.floor(i / block).cast("int")
            high = F.floor(i / block**2).cast("int")
            near = join(total(one, high * block, low), total(c, low * block, i + 1))
            return F.when(high == 0, near).otherwise(join(total(two, F.lit(0), high), near))

        return F.transform(c, entry)

    return let(values, lambda c: let(totals(c), lambda one: let(totals(one), lambda two: entries(c, one, two))))


def unit(*cols: Column | str, seed: int) -> Column:
    """Uniform number in [0, 1) that depends on the seed and the columns only."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 11)
    return bits.cast("double") / F.lit(float(1 << 53))


def ordered_slots(
    df: DataFrame,
    group: list[str],
    order: str,
    tie: str,
    *,
    buckets: int,
    slot: str,
    weight: str | None = None,
    before: str | None = None,
) -> DataFrame:
    """Gapless position of every row in its group, in the order of a uniform number.

    ``order`` holds numbers in [0, 1); it is cut into ``buckets`` equal ranges,
    so no task sorts a whole group: each (group, range) is numbered on its own
    and shifted by the count of the ranges below it, taken from a table with one
    row per (group, range). With ``weight``, ``before`` gets the weight of all
    rows that stand earlier in the group.
    """
    rows = df.withColumn("_range", F.floor(F.col(order) * buckets).cast("int"))
    keys = [*group, "_range"]
    total = F.sum(weight) if weight else F.count(F.lit(1))
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), total.alias("_w"))
    lower = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"_o_{k}") for k in keys],
        F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_n0"),
        F.coalesce(F.sum("_w").over(lower), F.lit(0)).alias("_w0"),
    )
    inside = Window.partitionBy(*keys).orderBy(order, tie)
    numbered = rows.withColumn(slot, F.row_number().over(inside) - 1)
    if weight:
        earlier = inside.rowsBetween(Window.unboundedPreceding, -1)
        numbered = numbered.withColumn(before, F.coalesce(F.sum(weight).over(earlier), F.lit(0)))
    match = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in keys]
    joined = numbered.join(offsets, match, "left")
    joined = joined.withColumn(slot, (F.col(slot) + F.col("_n0")).cast("long"))
    if weight:
        joined = joined.withColumn(before, F.col(before) + F.col("_w0"))
    return joined.drop("_range", "_n0", "_w0", *[f"_o_{k}" for k in keys])
