"""Operator 3: conflict-constrained best-fit packing.

Texts are cut into pieces of at most the capacity and packed into bins. Open
bins are ordered by what room they have left and carry a bitmap of the sources
and one of the duplicate clusters in them. A piece goes to the tightest bin it
fits that holds neither its source nor its cluster: the search starts at the
first bin with enough room and moves on to the successor until one is
compatible. Pieces go largest first.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import materialise
from weekly_mart.llm.temperature_mix import with_tokens

#: Tokens (white-space words) of a bin.
CAPACITY = 2048
#: Pieces that one task packs on average.
GROUP_PIECES = 4096


def best_fit(
    sizes: list[int], sources: list, clusters: list, capacity: int
) -> tuple[list[int], list[int]]:
    """Bin and offset of each piece; pieces have to come largest first."""
    source_bit = {s: 1 << k for k, s in enumerate(dict.fromkeys(sources))}
    # a cluster with one piece can't conflict and needs no bit
    often = [c for c, n in Counter(clusters).items() if n > 1]
    cluster_bit = {c: 1 << k for k, c in enumerate(often)}
    room: list[tuple[int, int]] = []  # open bins by room left, then number
    in_source: list[int] = []
    in_cluster: list[int] = []
    used: list[int] = []
    bins, offsets = [], []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = source_bit[source], cluster_bit.get(cluster, 0)
        at = bisect_left(room, (size, -1))
        while at < len(room) and (in_source[room[at][1]] & s or in_cluster[room[at][1]] & c):
            at += 1
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(used)
            in_source.append(0)
            in_cluster.append(0)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        in_source[b] |= s
        in_cluster[b] |= c
        if left - size > 0 or size == 0:
            insort(room, (left - size, b))
    return bins, offsets


def _pack(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("_rid", "ascending"), ("piece", "ascending")])
        bins, offsets = best_fit(
            group["size"].to_pylist(), group["source"].to_pylist(), group["cluster"].to_pylist(), capacity
        )
        own = group["group"].to_numpy().astype(np.int64) << 32
        filled = np.bincount(bins, group["size"].to_numpy(), minlength=max(bins) + 1).astype(np.int64)
        keep = group.select(["_id", "source", "cluster", "piece", "start", "size"])
        keep = keep.append_column("bin", pa.array(own + np.array(bins, np.int64)))
        keep = keep.append_column("offset", pa.array(offsets, pa.int64()))
        return keep.append_column("bin_tokens", pa.array(filled[bins]))

    return run


def pack(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, cluster_col: str | None = None,
) -> DataFrame:
    """One row per piece: id, source, cluster, piece, ``start`` and ``size`` in tokens, ``bin``,
    ``offset`` in the bin and ``bin_tokens``.

    The cluster of a text is the hash of its words, so texts that differ in white
    space only are of one cluster; or it is what ``cluster_col`` holds, such as
    the component of near copies (rows with a null there go by their words).
    Texts of one cluster, and the pieces of one text, never share a bin, nor do
    two texts of one source (a null source is a source). A text without words is one empty piece.
    Every token of every row is in exactly one piece; rows with equal ids are
    packed like other rows. An empty table gives an empty result.

    Pieces are dealt to groups at random and packed group by group: a task
    holds about ``group_pieces`` narrow rows, whatever key is hot.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    spaced = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    cluster = F.xxhash64(F.lit("words"), F.array_remove(F.split(spaced, " "), ""))
    if cluster_col:
        given = F.col(cluster_col)
        cluster = F.when(given.isNull(), cluster).otherwise(F.xxhash64(F.lit("given"), given))
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).cast("string").alias("source"),
        cluster.alias("cluster"), text.alias("_text"),
    )
    counted = materialise(
        with_tokens(rows, "_text").withColumn("_rid", F.monotonically_increasing_id()), "pack-rows"
    )
    pieces_of = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1)).cast("long")
    n = counted.agg(F.coalesce(F.sum(pieces_of), F.lit(0))).first()[0]
    groups = max(1, -(-n // group_pieces))
    pieces = (
        counted.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), pieces_of - 1)))
        .withColumn("start", F.col("piece") * capacity)
        .withColumn("size", F.least(F.col("tokens") - F.col("start"), F.lit(capacity).cast("long")))
        .withColumn("group", F.pmod(F.xxhash64("_rid", "piece"), F.lit(groups)))
        .select("group", "_rid", "_id", "source", "cluster", "piece", "start", "size")
    )
    kind = pieces.schema["_id"].dataType.simpleString()
    packed = pieces.groupBy("group").applyInArrow(
        _pack(capacity),
        f"_id {kind}, source string, cluster long, piece long, start long, size long, bin long, offset long, "
        "bin_tokens long",
    )
    return packed.withColumnsRenamed({"_id": id_col, "source": source_col})
