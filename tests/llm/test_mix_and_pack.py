import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from weekly_mart.llm.best_fit_packing import best_fit, pack
from weekly_mart.llm.temperature_mix import mix_sources, mixture, repeat_to_weights, with_tokens


def sources(n=400):
    """Sources with 8 : 4 : 1 of the documents."""
    share = ["big"] * 8 + ["mid"] * 4 + [None]
    return [(i, " ".join(f"w{i}" for _ in range(5 + i % 23)), "en", share[i % 13]) for i in range(n)]


def tokens_by_source(rows, column=3):
    out = Counter()
    for r in rows:
        out[r[column]] += len((r[1] or "").split())
    return out


@pytest.mark.parametrize(("entropy", "repeats"), [(None, 2.0), (1.3, None), (None, 100.0), (0.1, 4.0)])
def test_exponent_meets_the_target(make_docs, entropy, repeats):
    rows = sources()
    counted = with_tokens(make_docs(rows).select("doc_id", "source", "text"), "text")
    mix = mixture(counted, target_entropy=entropy, max_repeats=repeats)
    t = np.array(list(tokens_by_source(rows).values()), float)

    def at(alpha):
        w = t**alpha / (t**alpha).sum()
        seen = w / t / (w / t).min()
        return -(w * np.log2(w)).sum(), seen.max(), w

    h, most, w = at(mix.alpha)
    assert abs(h - mix.entropy) < 1e-9
    assert sorted(round(r["weight"], 9) for r in mix.shares.collect()) == sorted(np.round(w, 9))
    ok = lambda a: (entropy is None or at(a)[0] <= entropy + 1e-6) and (repeats is None or at(a)[1] <= repeats + 1e-6)
    if mix.alpha < 1:
        assert ok(mix.alpha)
        assert mix.alpha == 0 or not ok(mix.alpha - 1e-4)


def test_budgets_blocks_and_epochs(make_docs):
    rows = sources()
    got = mix_sources(make_docs(rows), max_repeats=2.0, block_tokens=500).collect()
    per = defaultdict(Counter)
    for r in got:
        per[r["source"]][r["epoch"]] += 1
    docs = Counter(r[3] for r in rows)
    for source, n in docs.items():
        assert per[source][0] == n  # the first epoch is whole
    drawn, total = Counter(), 0
    for r in got:
        drawn[r["source"]] += r["tokens"]
        total += r["tokens"]
    weights = {r["source"]: r["weight"] for r in got}
    for source, w in weights.items():
        assert abs(drawn[source] / total - w) < 0.02
    # every block has each source's share, and its slots are gapless
    blocks = defaultdict(list)
    for r in got:
        blocks[r["block"]].append(r)
    assert len(blocks) == math.ceil(total / 500) or abs(len(blocks) - total / 500) < 2
    for b in blocks.values():
        assert sorted(r["slot"] for r in b) == list(range(len(b)))
        assert abs(sum(r["tokens"] for r in b if r["source"] == "big") - 500 * weights["big"]) < 60
    # one epoch is a permutation, and the second another one
    order = lambda e: [r["doc_id"] for r in sorted(got, key=lambda r: (r["block"], r["slot"])) if r["epoch"] == e and r["source"] is None]
    assert sorted(order(0)) == sorted(i for i, *_, s in rows if s is None)
    assert order(1) and order(1) != order(0)[: len(order(1))]


def test_repeating_rows_follows_the_plan(make_docs):
    rows = sources()
    docs = make_docs(rows)
    planned = Counter(r["source"] for r in mix_sources(docs, max_repeats=2.0).collect())
    got = repeat_to_weights(docs, max_repeats=2.0)
    assert got.columns == docs.columns
    found = got.collect()
    assert {r["doc_id"] for r in found} == {i for i, *_ in rows}
    assert max(Counter(r["doc_id"] for r in found).values()) <= 2
    for source, n in Counter(r["source"] for r in found).items():
        assert abs(n - planned[source]) <= 2


def test_mixing_odd_rows(make_docs, clashing, odd_rows):
    assert {r["doc_id"] for r in mix_sources(clashing).collect()} == {i for i, *_ in odd_rows}
    repeated = repeat_to_weights(clashing)
    assert repeated.columns == clashing.columns
    assert repeated.count() >= len(odd_rows)
    assert mix_sources(make_docs([])).collect() == []
    assert repeat_to_weights(make_docs([])).collect() == []
    assert mix_sources(make_docs([(1, None), (2, "")])).count() == 2


def naive_best_fit(sizes, sources, clusters, capacity):
    room, taken, bins = [], [], []
    for n, s, c in zip(sizes, sources, clusters, strict=True):
        fits = [(r, k) for k, r in enumerate(room) if r >= n and (r > 0 or n == 0) and s not in taken[k][0] and c not in taken[k][1]]
        if fits:
            k = min(fits)[1]
        else:
            k = len(room)
            room.append(capacity)
            taken.append((set(), set()))
        room[k] -= n
        taken[k][0].add(s)
        taken[k][1].add(c)
        bins.append(k)
    return bins


def test_best_fit_against_a_full_scan():
    rng = np.random.default_rng(5)
    sizes = sorted((int(x) for x in rng.integers(1, 60, 300)), reverse=True)
    origin = [int(x) for x in rng.integers(0, 6, 300)]
    cluster = [int(x) for x in rng.integers(0, 120, 300)]
    bins, offsets = best_fit(sizes, origin, cluster, 64)
    assert bins == naive_best_fit(sizes, origin, cluster, 64)


def test_every_token_is_packed_once(make_docs):
    rows = sources(300) + [(900, " ".join(["long"] * 205), "en", "mid"), (901, "same text", "en", "x"), (902, "same text", "en", "y")]
    got = pack(make_docs(rows), capacity=50, group_pieces=64).collect()
    by_doc, by_bin = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_bin[r["bin"]].append(r)
    for i, text, *_ in rows:
        pieces = sorted(by_doc[i], key=lambda r: r["piece"])
        assert [p["start"] for p in pieces] == list(range(0, len(text.split()), 50))
        assert sum(p["size"] for p in pieces) == len(text.split())
    for b in by_bin.values():
        assert sum(r["size"] for r in b) == b[0]["bin_tokens"] <= 50
        assert len({r["source"] for r in b}) == len({r["cluster"] for r in b}) == len(b)
        at = 0
        for r in sorted(b, key=lambda r: (r["offset"], r["size"])):
            assert r["offset"] == at
            at += r["size"]


def test_packing_odd_rows(make_docs, clashing, odd_rows):
    got = pack(clashing, capacity=2048).collect()
    assert Counter(r["doc_id"] for r in got if r["piece"] == 0) == Counter(i for i, *_ in odd_rows)
    assert sum(r["size"] for r in got) == sum(len((t or "").split()) for _, t, *_ in odd_rows)
    assert pack(make_docs([])).collect() == []


def test_entropy_below_that_of_the_natural_shares(make_docs):
    rows = sources()
    counted = with_tokens(make_docs(rows).select("doc_id", "source", "text"), "text")
    natural = mixture(counted, max_repeats=1.0).entropy
    mix = mixture(counted, target_entropy=natural / 2, max_repeats=None)
    assert mix.alpha > 1 and abs(mix.entropy - natural / 2) < 1e-6
    with pytest.warns(UserWarning, match="not met"):
        mixture(counted, target_entropy=natural / 2, max_repeats=1.01)
