"""Operator 1: exact dedup by progressive refinement.

Texts are grouped by length, then by a hash of their first bytes, then by a
hash of the whole text; each step looks only at the groups the step before
left with two rows or more. Rows are compared by length and SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import forget, materialise, maybe_in, membership, packed, unpacked

#: Characters that the second step hashes.
PREFIX_CHARS = 128


def _suspects(rows: DataFrame) -> DataFrame:
    """(_len, _prefix) that two rows have. Step 1: lengths that occur twice. Step 2: of those, prefix hashes that do."""
    by_prefix = rows.groupBy("_len", "_prefix").agg(F.count(F.lit(1)).alias("_n"))
    by_length = by_prefix.groupBy("_len").agg(F.sum("_n").alias("_n")).where("_n > 1").select("_len")
    return materialise(
        by_prefix.where("_n > 1").join(by_length, "_len", "left_semi").select("_len", "_prefix"),
        "dedup-suspects",
    )


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = PREFIX_CHARS,
    digest_col: str | None = None,
) -> DataFrame:
    """One row per input row: the id, ``keep_id``, ``group_size`` and ``kept``.

    A null text counts as empty. Of equal texts the row with the largest id is
    kept; rows without id lose against any other. Repeated rows (same id and
    text) are copies like any other and are all marked ``kept`` where their id
    is the one that stays (`drop_copies` keeps a single one of them). An empty
    table gives an empty result. Only the id and the text are read, so extra
    columns can't clash.

    ``digest_col`` names a column that gets the SHA-256 of every row's text.
    Without it the whole text is hashed for surviving groups only.

    Scale: the first two steps run on one aggregate per (length, prefix hash),
    combined before the shuffle, so a length or a text that a third of all rows
    share costs one partial row per task. The two small tables of surviving
    groups are written before rows are joined to them, so that the joins are
    plain ones, whose hot keys AQE splits.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"),
        F.octet_length(text).alias("_len"),
        F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_prefix"),
        (F.sha2(text, 256) if digest_col else text).alias("_content"),
    )
    suspects = _suspects(rows)
    # Step 3: the whole text, of rows in surviving groups only.
    full: Column = F.col("_content") if digest_col else F.sha2(F.col("_content"), 256)
    survivors = rows.join(suspects, ["_len", "_prefix"], "left_semi").select(
        "_id", "_len", full.alias("_sha")
    )
    groups = materialise(
        survivors.groupBy("_len", "_sha")
        .agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_size"))
        .where("_size > 1"),
        "dedup-groups",
    )
    if digest_col:
        rows = rows.select("_id", "_len", F.col("_content").alias("_sha"))
        joined = rows.join(groups, ["_len", "_sha"], "left")
    else:
        alone = rows.join(suspects, ["_len", "_prefix"], "left_anti").select(
            "_id", "_len", F.lit(None).cast("string").alias("_sha")
        )
        joined = survivors.unionByName(alone).join(groups, ["_len", "_sha"], "left")
    size = F.coalesce("_size", F.lit(1)).cast("long")
    keep = F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep"))
    out = [
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        size.alias("group_size"),
        (F.col("_size").isNull() | F.col("_id").eqNullSafe(F.col("_keep"))).alias("kept"),
    ]
    return joined.select(*out, *([F.col("_sha").alias(digest_col)] if digest_col else []))


def drop_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", prefix_chars: int = PREFIX_CHARS
) -> DataFrame:
    """The rows of ``docs`` that `exact_dedup` keeps, with all their columns, whatever their names.

    Null texts count as empty. Repeated rows with the same id and text leave one
    row, as does a group whose ids are all null. An empty table stays empty.

    Scale: rows whose length and prefix hash no other row has pass as they are
    read, without a shuffle; a filter of fixed size (`membership`) tells them
    apart. Only the others are hashed whole and written, and of those only rows
    that a second filter takes for the one that stays meet their group again, so
    the texts of dropped copies are never shuffled, however many they are.
    """
    rows = packed(docs)
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    keyed = rows.select(
        "row", F.octet_length(text).alias("_len"), F.xxhash64(F.substring(text, 1, prefix_chars)).alias("_prefix")
    )
    suspects = _suspects(keyed.drop("row"))
    tagged = maybe_in(keyed, membership(suspects, "_len", "_prefix"), "_len", "_prefix", flag="seen")
    forget(suspects)
    hashed = materialise(
        tagged.where("seen").select(
            "row", F.col("row").getField(id_col).alias("_id"), "_len", F.sha2(text, 256).alias("_sha")
        ),
        "dedup-rows",
    )
    groups = materialise(hashed.groupBy("_len", "_sha").agg(F.max("_id").alias("_id")), "dedup-groups")
    likely = maybe_in(hashed, membership(groups, "_sha", "_id"), "_sha", "_id", flag="stays").where("stays")
    named = groups.select(F.col("_len").alias("_n"), F.col("_sha").alias("_s"), F.col("_id").alias("_keep"))
    kept = (
        likely.join(named, (F.col("_len") == F.col("_n")) & (F.col("_sha") == F.col("_s")) & F.col("_id").eqNullSafe(F.col("_keep")))
        .groupBy("_len", "_sha").agg(F.first("row").alias("row"))
    )
    return unpacked(tagged.where("NOT seen").select("row").unionByName(kept.select("row")), docs.columns)
