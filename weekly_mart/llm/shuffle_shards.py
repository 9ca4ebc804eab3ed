"""Operator 7: uniform sharding through a hypergeometric communication matrix.

Law ``rows``: shard sizes differ by one at most. The method works on the input
partitions: it draws how many rows each partition sends to each shard from the
exact multivariate hypergeometric law, permutes every partition locally and
sends rows by those counts, and permutes again inside the shards. The result
is a uniform random permutation cut into shards of exact sizes. DataFrame
functions only. It has no groups: equal texts spread like any other rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import materialise, ordered_slots, packed, unit

#: Rows that one range of a shard holds on average while it is numbered.
ROWS_PER_RANGE = 20_000
#: Standard deviations on each side of the mode that a draw can reach; what lies
#: beyond has a probability far below the resolution of a double.
REACH = 12


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _draw(population: Column, marked: Column, picked: Column, u: Column) -> Column:
    """Hypergeometric draw by inversion: marked items among ``picked`` of ``population``.

    Weights relative to the mode follow from the ratio of neighbouring
    probabilities; the outcomes are walked from the mode up, then from the mode
    down, once for the sum of weights and once to the target.
    """
    share = F.when(population > 0, marked / population).otherwise(F.lit(0.0))
    spread = F.ceil(REACH * F.sqrt(picked * share * (1 - share)) + REACH)
    low = F.greatest(F.lit(0).cast("long"), picked + marked - population)
    high = F.least(picked, marked)
    mode = F.floor((picked + 1.0) * (marked + 1.0) / (population + 2.0))
    base = F.struct(
        population.alias("pop"), marked.alias("good"), picked.alias("picks"), low.alias("low"),
        high.alias("high"), F.least(F.greatest(mode, low), high).alias("mode"), spread.alias("spread"),
    )

    def solve(p: Column) -> Column:
        def up(x: Column) -> Column:  # weight of x over weight of x - 1
            return (p.good - x + 1.0) * (p.picks - x + 1.0) / (x * (p["pop"] - p.good - p.picks + x + 0.0))

        top = F.least(p.high, p.mode + p.spread)
        bottom = F.greatest(p.low, p.mode - p.spread)
        below = F.when(bottom < p.mode, F.sequence(p.mode - 1, bottom, F.lit(-1).cast("long"))).otherwise(
            F.array().cast("array<bigint>")
        )
        outcomes = F.concat(F.sequence(p.mode, top), below)

        def weight(last: Column, x: Column) -> Column:
            return (
                F.when(x == p.mode, F.lit(1.0))
                .when(x > p.mode, last * up(x))
                .when(x == p.mode - 1, 1 / up(p.mode))
                .otherwise(last / up(x + 1))
            )

        def walk(target: Column) -> Column:
            start = F.struct(
                F.lit(1.0).alias("w"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("hit")
            )

            def step(s: Column, x: Column) -> Column:
                return _let(
                    weight(s.w, x),
                    lambda w: F.struct(
                        w.alias("w"), (s["sum"] + w).alias("sum"),
                        F.when(s.hit.isNull() & (target < s["sum"] + w), x).otherwise(s.hit).alias("hit"),
                    ),
                )

            return F.aggregate(outcomes, start, step)

        return _let(
            walk(F.lit(0.0))["sum"] * u, lambda target: F.coalesce(walk(target).hit, p.mode)
        )

    return _let(base, solve)


def _split(node_rows: Column, room: Column, seed: int, node: Column) -> Column:
    """Multivariate draw: how many of each shard's ``room`` the first ``node_rows`` rows take.

    One shard after the other, each given what the earlier ones left.
    """
    start = F.struct(
        F.aggregate(room, F.lit(0).cast("long"), lambda a, x: a + x).alias("pop"),
        node_rows.cast("long").alias("picks"),
        F.array().cast("array<bigint>").alias("out"),
    )

    def one(s: Column, shard: Column) -> Column:
        k = F.element_at(room, shard)
        got = _draw(s["pop"], k, s.picks, unit(node, shard, seed=seed))
        return _let(
            got,
            lambda x: F.struct(
                (s["pop"] - k).alias("pop"), (s.picks - x).alias("picks"),
                F.concat(s.out, F.array(x)).alias("out"),
            ),
        )

    return F.aggregate(F.sequence(F.lit(1), F.size(room)), start, one).out


def communication_matrix(counts: DataFrame, parts: int, rows: int, shards: int, seed: int) -> DataFrame:
    """(part, sends): how many rows each input partition sends to each shard.

    ``counts`` has one row per partition (part, n). The partitions are halved
    again and again; each halving draws the left half's share of every shard's
    remaining room, which gives the exact joint law in log2(parts) steps that
    run side by side. Only counts move here, one number per partition. The first
    levels have few nodes, so the list of partitions (one number each) stands in
    a few rows until level 6; a draw walks 24 standard deviations of outcomes,
    about 2.4 million numbers for 10^11 rows.
    """
    sizes = [rows // shards + (s < rows % shards) for s in range(shards)]
    tree = counts.agg(F.sort_array(F.collect_list(F.struct("part", "n"))).alias("leaves")).select(
        F.lit(1).cast("long").alias("node"),
        "leaves",
        F.array(*[F.lit(x).cast("long") for x in sizes]).alias("room"),
    )
    for level in range(max(0, math.ceil(math.log2(max(1, parts))))):
        half = F.ceil(F.size("leaves") / 2).cast("int")
        left = F.slice("leaves", F.lit(1), half)
        right = F.slice("leaves", half + 1, F.size("leaves") - half)
        node, room = F.col("node"), F.col("room")

        def child(number: Column, leaves: Column, part: Column) -> Column:
            return F.struct(number.alias("node"), leaves.alias("leaves"), part.alias("room"))

        def halves(taken: Column) -> Column:
            rest = F.zip_with(room, taken, lambda r, t: r - t)
            return F.array(child(node * 2, left, taken), child(node * 2 + 1, right, rest))

        rows_left = F.aggregate(left, F.lit(0).cast("long"), lambda a, x: a + x.n)
        both = F.when(
            F.size("leaves") > 1, _let(_split(rows_left, room, seed, node), halves)
        ).otherwise(F.array(child(node * 2, F.col("leaves"), room)))
        tree = tree.select(F.explode_outer(both).alias("c")).select("c.*")
        if level in (6, 10):
            tree = tree.repartition(2**level, "node")
    return tree.select(F.explode("leaves").alias("leaf"), "room").select(
        F.col("leaf.part").alias("part"), F.col("room").alias("sends")
    )


def shard_rows(
    docs: DataFrame, *, shards: int = 8, seed: int = 20, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """All rows of ``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0).

    Values are never looked at: nulls, repeated rows and ties are dealt like
    other rows. An empty table gives an empty result. Columns named ``shard`` or
    ``slot`` are replaced; all others come back unchanged, whatever their names.

    The rows are first written to the shared scratch folder with the number of
    the partition they came from; from there on every step is a function of
    written data, so a lost executor repeats it alike. Pass narrow rows (an id)
    and join wide columns back where they are needed.
    """
    kept = docs.drop("shard", "slot")
    fixed = materialise(
        packed(kept)
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_rid", F.monotonically_increasing_id()),
        "shard-rows",
    )
    counts = materialise(fixed.groupBy(F.col("_part").alias("part")).agg(F.count(F.lit(1)).alias("n")), "parts")
    # two scalars: how many partitions and rows there are
    parts, rows = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    matrix = communication_matrix(counts, parts, rows, shards, seed).select(
        F.col("part").alias("_p"), "sends"
    )
    # Permute every partition locally, in ranges of a uniform number, and deal it out by the matrix.
    ranges = max(1, math.ceil(rows / max(1, parts) / rows_per_range))
    local = ordered_slots(
        fixed.withColumn("_u", unit("_rid", seed=seed + 1)), ["_part"], "_u", "_rid",
        buckets=ranges, slot="_rank",
    )
    dealt = local.join(matrix, F.col("_part") == F.col("_p"), "left").withColumn(
        "shard",
        F.aggregate(
            "sends",
            F.struct(F.lit(0).cast("long").alias("c"), F.lit(0).alias("s")),
            lambda a, x: F.struct(
                (a.c + x).alias("c"), (a.s + F.when(F.col("_rank") >= a.c + x, 1).otherwise(0)).alias("s")
            ),
        ).s,
    )
    # Permute again inside the shards.
    ranges = max(1, math.ceil(rows / shards / rows_per_range))
    out = ordered_slots(
        dealt.drop("_p", "sends", "_rank").withColumn("_u", unit("_rid", seed=seed + 2)),
        ["shard"], "_u", "_rid", buckets=ranges, slot="slot",
    )
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept.columns], "shard", "slot")
