"""Operator 4: mixing sources to target weights by temperature.

A source's weight is its share of tokens to the power alpha, normalised. The
exponent is narrowed down until the mixture has the target entropy, and no
source is repeated more often than the limit. The weights are then realised:
every source gets a budget of tokens, which runs through permutations of its
documents, epoch after epoch, and every block of the mixture takes each
source's share from that run.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import bound_batches, materialise, ordered_slots, packed, unit, unpacked
from weekly_mart.llm.textscan import chunks

#: No source is seen more often than this.
MAX_REPEATS = 2.0
#: Tokens of one block of the mixture.
BLOCK_TOKENS = 1_000_000
#: Rows that one range of a source's permutation holds on average while it is numbered.
ROWS_PER_RANGE = 4_000


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = batch.num_columns - 1
        counts = [np.diff(c.first_of(c.words()[0])) for c in chunks(batch.column(n))]
        tokens = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:n], pa.array(tokens.astype(np.int64))], names=[*batch.schema.names[:n], "tokens"]
        )


def with_tokens(rows: DataFrame, text: str) -> DataFrame:
    """The other columns of ``rows`` and ``tokens``: white-space words of the whole text (null: 0)."""
    bound_batches(rows.sparkSession)
    kept = [c for c in rows.columns if c != text]
    narrow = rows.select(*kept, F.col(text).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(_count_words, f"{schema}, tokens long")


@dataclass
class Mixture:
    """One row per source with tokens: source, tokens, weight, budget, repeats."""

    alpha: float
    entropy: float
    total: float
    shares: DataFrame


def fit_exponent(
    totals: DataFrame, *, target_entropy: float | None, max_repeats: float | None, ways: int = 32, rounds: int = 7
) -> float:
    """Smallest exponent that meets the limits, for a table (tokens) of sources.

    Entropy (in bits) and repetition fall as the exponent grows, so the interval
    that holds the answer can be cut; every round cuts it into ``ways`` parts
    with one aggregate over the sources, however many there are. A target below
    the entropy of the natural shares takes an exponent above 1, where the large
    sources are repeated; if the repetition limit or equal sources forbid it,
    the nearest exponent is returned with a warning.
    """
    top, bottom = totals.agg(F.max("tokens"), F.min("tokens")).first()
    if not top:
        return 1.0
    spread = math.log(top / bottom)
    low, high = 0.0, 1.0

    def entropy(alpha: float, z: float, zl: float) -> float:
        return (math.log(z) - alpha * zl / z) / math.log(2)

    def met(alpha: float, z: float, zl: float) -> bool:
        repeats = math.exp(spread * abs(1 - alpha))
        return (target_entropy is None or entropy(alpha, z, zl) <= target_entropy + 1e-12) and (
            max_repeats is None or repeats <= max_repeats * (1 + 1e-12)
        )

    log = F.log(F.col("tokens") / F.lit(float(top)))

    def entropy_at(alpha: float) -> float:
        return entropy(alpha, *totals.agg(F.sum(F.exp(log * alpha)), F.sum(F.exp(log * alpha) * log)).first())

    if target_entropy is not None and (seen := entropy_at(1.0)) > target_entropy + 1e-12:
        limit = 1 + max(0.0, math.log(max_repeats)) * (1 - 1e-12) / spread if max_repeats and spread else math.inf
        low = high = 1.0
        while seen > target_entropy + 1e-12:
            low, high, before = high, min(2 * high, limit), seen
            seen = entropy_at(high)
            if seen > target_entropy + 1e-12 and (high >= limit or before - seen < 1e-12):
                warnings.warn(f"target entropy {target_entropy} not met: {seen} at exponent {high}", stacklevel=2)
                return high
    for _ in range(rounds):
        tried = [low + (high - low) * k / ways for k in range(ways)]
        sums = totals.agg(
            *[F.sum(F.exp(log * a)) for a in tried], *[F.sum(F.exp(log * a) * log) for a in tried]
        ).first()
        good = [k for k, a in enumerate(tried) if met(a, sums[k], sums[ways + k])]
        if good and good[0] == 0:
            return tried[0]
        at = good[0] if good else ways
        high = tried[at] if good else high
        low = tried[at - 1]
    return high


def mixture(
    rows: DataFrame, *, target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS
) -> Mixture:
    """Weights for a table with ``source`` and ``tokens`` (a null source is a source).

    The total budget is the least one in which every source is used whole at
    least once. Sources without tokens have no weight.
    """
    totals = materialise(
        rows.groupBy("source").agg(F.sum("tokens").cast("double").alias("tokens")).where("tokens > 0"),
        "source-tokens",
    )
    alpha = fit_exponent(totals, target_entropy=target_entropy, max_repeats=max_repeats)
    top = totals.agg(F.max("tokens")).first()[0] or 1.0
    part = F.pow(F.col("tokens") / top, F.lit(alpha))
    z, need, entropy_sum = totals.agg(
        F.sum(part), F.max(F.col("tokens") / part), F.sum(part * F.log(part))
    ).first()
    z, need = z or 1.0, need or 0.0
    weight = part / z
    budget = weight * (need * z)
    shares = totals.select(
        "source", "tokens", weight.alias("weight"), budget.alias("budget"),
        F.greatest(budget / F.col("tokens"), F.lit(1.0)).alias("repeats"),
    )
    entropy = (math.log(z) - (entropy_sum or 0.0) / z) / math.log(2)
    return Mixture(alpha, entropy, need * z, shares)


def _order(key: Column | str, epoch: Column, seed: int) -> Column:
    return unit(key, epoch.cast("int"), seed=seed)


def mix_plan(
    rows: DataFrame, mix: Mixture, *, key: str, seed: int = 4, block_tokens: int = BLOCK_TOKENS,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """The mixture, one row per document and epoch: the columns of ``rows`` and ``epoch``, ``weight``,
    ``block`` and ``slot``.

    ``rows`` (a written table) has source, tokens and a long ``key`` that tells
    rows apart. The last epoch of a source ends where its budget is reached.
    Permutations are numbered in ranges of a uniform number, so a source that
    holds most rows is spread over tasks.
    """
    n = rows.count()
    buckets = max(1, math.ceil(n / rows_per_range))
    shares = mix.shares.select(F.col("source").alias("_s"), "weight", "budget", "repeats", F.col("tokens").alias("_t"))
    seen = rows.join(shares, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    epochs = F.greatest(F.ceil(F.coalesce("repeats", F.lit(1.0)) - 1e-9), F.lit(1)).cast("int")
    copies = seen.withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
    copies = copies.withColumn("_u", _order(key, F.col("epoch"), seed))
    run = ordered_slots(
        copies, ["source", "epoch"], "_u", key, buckets=buckets, slot="_n", weight="tokens", before="_before"
    )
    progress = F.col("epoch") * F.coalesce("_t", F.lit(0.0)) + F.col("_before")
    # the first epoch is whole, whatever rounding says
    within = run.where((F.col("epoch") == 0) | (progress < F.col("budget") * (1 - 1e-12)))
    blocks = max(1, math.ceil(mix.total / block_tokens))
    placed = within.withColumn(
        "block",
        F.least(F.floor(F.coalesce(progress / F.col("budget"), F.col("_u")) * blocks), F.lit(blocks - 1)).cast("long"),
    ).withColumn("_v", unit(key, F.col("epoch"), seed=seed + 1))
    out = ordered_slots(placed, ["block"], "_v", key, buckets=1, slot="slot")
    return out.drop("_u", "_v", "_n", "_before", "_t", "budget", "repeats")


def mix_sources(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS,
    block_tokens: int = BLOCK_TOKENS, seed: int = 4,
) -> DataFrame:
    """The mixture of a table: id, source, tokens, epoch, weight, block, slot.

    Every row of the table is there at least once. A null source is a source of
    its own; documents without tokens come once. Rows with equal ids or texts
    are rows like any other. An empty table gives an empty result. Only the
    three named columns are read.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"), F.col(text_col).alias("_text")
    )
    counted = materialise(
        with_tokens(rows, "_text").withColumn("_rid", F.monotonically_increasing_id()), "mix-rows"
    )
    plan = mix_plan(
        counted, mixture(counted, target_entropy=target_entropy, max_repeats=max_repeats), key="_rid",
        seed=seed, block_tokens=block_tokens,
    )
    return plan.select(
        F.col("_id").alias(id_col), F.col("source").alias(source_col), "tokens", "epoch", "weight", "block", "slot"
    )


def repeat_to_weights(
    docs: DataFrame, *, text_col: str = "text", source_col: str = "source",
    target_entropy: float | None = None, max_repeats: float | None = MAX_REPEATS, seed: int = 4,
) -> DataFrame:
    """``docs`` with every row as often as the mixture holds it, columns unchanged, whatever their names.

    How often follows from the row itself and one line per source: the whole
    epochs, and the place in the last permutation where the budget ends. So
    texts are never shuffled; the plan is made on narrow rows. Null texts have
    no words and come once, as other texts without words do; a null source is a
    source; repeated rows come equally often; an empty table stays empty.
    """
    columns = docs.columns
    text = F.coalesce(F.col("row").getField(text_col).cast("string"), F.lit(""))
    others = [F.col("row").getField(c) for c in columns if c != text_col]
    keyed = packed(docs).select(
        "row", F.col("row").getField(source_col).alias("source"), text.alias("_text"),
        F.xxhash64(*others, F.xxhash64(text)).alias("_key"),
    )
    counted = materialise(with_tokens(keyed.drop("row"), "_text"), "mix-rows")
    mix = mixture(counted, target_entropy=target_entropy, max_repeats=max_repeats)
    plan = mix_plan(counted, mix, key="_key", seed=seed)
    ends = materialise(
        plan.groupBy("source", "epoch").agg(F.max(_order("_key", F.col("epoch"), seed)).alias("end"))
        .groupBy("source").agg(F.max(F.struct("epoch", "end")).alias("last"))
        .select(F.col("source").alias("_s"), F.col("last.epoch").alias("_epoch"), F.col("last.end").alias("_end")),
        "mix-ends",
    )
    tagged = keyed.join(ends, F.col("source").eqNullSafe(F.col("_s")), "left")
    last = F.coalesce("_epoch", F.lit(0))
    has_tokens = F.length(F.trim(F.translate("_text", "\t\n\x0b\x0c\r", "     "))) > 0
    times = F.when(has_tokens & (last > 0), last + (_order("_key", last, seed) <= F.col("_end")).cast("int"))
    copies = F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce(times, F.lit(1)), F.lit(1))))
    return unpacked(tagged.select("row", copies), columns)
