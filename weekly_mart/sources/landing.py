"""Landing files (CSV) and the strict Bronze loader.

Loader rules, fixed by the reference's load settings:
- every column is text, by position, under a declared schema;
- ``NA``, also between spaces, becomes NULL at load (NULL_IF), as does an empty
  field; other text keeps its spaces;
- one malformed row aborts the load (FAILFAST), and the error of a load names
  the file and line of every such row;
- the file header must name the schema's columns (enforceSchema=False), so a
  file with swapped columns fails instead of loading wrong data.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weekly_mart.schemas import RAW_SCHEMAS

NULL_TOKEN = "NA"
#: Bad rows that the message of a failed load spells out; `bad_rows` has them all.
NAMED_ROWS = 100


class LoadError(ValueError):
    """A load that was aborted: ``rows`` has the file, line and text of every malformed row."""

    def __init__(self, table: str, rows: DataFrame):
        found = rows.orderBy("file", "line").limit(NAMED_ROWS + 1).collect()
        named = [f"{r.file}:{r.line}: {r.record}" for r in found[:NAMED_ROWS]]
        if len(found) > NAMED_ROWS:
            named.append(f"and more, {rows.count()} in all")
        super().__init__("\n".join([f"{table}: malformed rows, nothing was loaded", *named]))
        self.rows = rows


def write_csv(df: DataFrame, path: str, workspace=None) -> None:
    """Write a landing folder of CSV files with a header, keeping text as is; the files are compressed."""
    opts = dict(header="true", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", compression="gzip")
    if workspace is not None:
        workspace.write(df, path, fmt="csv", **opts)
    else:
        df.write.mode("overwrite").options(**opts).csv(path)


def csv_reader(spark: SparkSession, table: str):
    return (
        spark.read.schema(RAW_SCHEMAS[table])
        .option("header", "true")
        .option("enforceSchema", "false")
        .option("nullValue", NULL_TOKEN)
        .option("mode", "FAILFAST")
    )


def _padded_nulls(df: DataFrame) -> DataFrame:
    return df.select(*[F.when(F.trim(c) != NULL_TOKEN, F.col(c)).alias(c) for c in df.columns])


def read_files(spark: SparkSession, table: str, paths: str | list[str]) -> DataFrame:
    """Scan files or folders as raw table ``table``, with the file's metadata at hand."""
    return _padded_nulls(csv_reader(spark, table).csv(paths))


def read_raw(spark: SparkSession, landing: str, table: str, folder: str | None = None) -> DataFrame:
    """Scan every file under ``{landing}/{folder or table}/`` as raw table ``table``."""
    return read_files(spark, table, f"{landing.rstrip('/')}/{folder or table}/")


def bad_rows(spark: SparkSession, table: str, paths: str | list[str]) -> DataFrame:
    """(file, line, record) of every row that the strict reader does not take; line 1 is the header.

    Lines are counted for each block of a file by itself and shifted by the
    blocks before it, so a file of any size is read in parallel.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"), F.regexp_replace("value", r"\r$", "").alias("record"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0)))
    schema = ", ".join([*[f"{f.name} string" for f in RAW_SCHEMAS[table]], "_bad string"])
    parsed = F.from_csv("record", F.lit(schema), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    return (
        lines.where("record <> ''").withColumn("bad", parsed.getField("_bad").isNotNull()).where("bad")
        .join(offsets.select("file", "block", "first", "offset"), ["file", "block"])
        .select("file", (F.col("id") - F.col("first") + F.col("offset") + 1).alias("line"), "record")
        .where("line > 1")
    )


def checked_load(spark: SparkSession, table: str, paths: str | list[str], load):
    """``load(rows)`` of the files; where a malformed row aborts it, the error names all of them."""
    try:
        return load(read_files(spark, table, paths))
    except (PySparkException, Py4JJavaError) as e:
        rows = bad_rows(spark, table, paths)
        if rows.isEmpty():
            raise
        raise LoadError(table, rows) from e


def arrivals_folder(folder: str) -> str:
    """Where uploads into a landing folder are announced: beside it, so that scans of the folder don't meet them."""
    parent, name = folder.rstrip("/").rsplit("/", 1)
    return f"{parent}/_arrivals/{name}"


def upload(spark: SparkSession, files: dict[str, str], landing: str) -> dict[str, str]:
    """Copy local CSV files into the landing layout ``{landing}/{table}/{table}.csv``.

    The object name is fixed per table, so a re-upload replaces its own file
    and a full reload never sees two copies of one table. Each upload is
    announced by a small file of its own (`streaming.uploads` reads them).
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    out = {}
    for table, local in files.items():
        if table not in RAW_SCHEMAS:
            raise ValueError(f"unknown table {table!r}; expected one of {sorted(RAW_SCHEMAS)}")
        dst = jvm.org.apache.hadoop.fs.Path(f"{landing.rstrip('/')}/{table}/{table}.csv")
        fs = dst.getFileSystem(conf)
        fs.copyFromLocalFile(False, True, jvm.org.apache.hadoop.fs.Path(local), dst)
        out[table] = dst.toString()
        said = jvm.org.apache.hadoop.fs.Path(
            f"{arrivals_folder(f'{landing}/{table}')}/{time.time_ns()}-{uuid.uuid4().hex}.txt"
        )
        with_path = fs.create(said)
        with_path.write(bytearray(fs.makeQualified(dst).toString().encode()))
        with_path.close()
    return out
