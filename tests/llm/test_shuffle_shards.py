from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from weekly_mart.llm.shuffle_shards import communication_matrix, shard_rows


def test_sizes_and_slots_are_exact(spark):
    got = shard_rows(spark.range(5000).repartition(13), shards=7, rows_per_range=100).collect()
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r["slot"])
    sizes = [len(v) for v in by_shard.values()]
    assert len(sizes) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by_shard.values())
    assert sorted(r["id"] for r in got) == list(range(5000))


def test_matrix_keeps_margins_and_follows_the_law(spark):
    counts = spark.range(64).select(F.col("id").cast("int").alias("part"), (F.col("id") * 50 + 4000).alias("n"))
    sizes = np.array([4000 + 50 * k for k in range(64)])
    rows = communication_matrix(counts, 64, int(sizes.sum()), 8, seed=5).collect()
    sent = np.array([r["sends"] for r in sorted(rows, key=lambda r: r["part"])])
    assert (sent.sum(1) == sizes).all()
    assert sent.sum(0).max() - sent.sum(0).min() <= 1
    share = sizes / sizes.sum()
    room = sent.sum(0)
    n = sizes.sum()
    expected = np.outer(share, room)
    variance = sizes[:, None] * (room / n) * (1 - room / n) * ((n - sizes) / (n - 1))[:, None]
    z = (sent - expected) / np.sqrt(variance)
    assert abs(z).max() < 5
    assert 0.85 < z.std() < 1.15


def test_odd_rows(make_docs, clashing, odd_rows):
    got = shard_rows(clashing, shards=3).collect()
    assert len(got) == len(odd_rows)
    assert max(Counter(r["shard"] for r in got).values()) <= 4
    assert Counter(r["text"] for r in got) == Counter(t for _, t, *_ in odd_rows)
    assert shard_rows(make_docs([])).collect() == []
    assert [r["slot"] for r in shard_rows(make_docs(odd_rows[:1]), shards=8).collect()] == [0]
