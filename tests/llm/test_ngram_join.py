import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from weekly_mart.llm import ngram_join
from weekly_mart.llm.components import components
from weekly_mart.llm.ngram_join import divide_skip, jaccard_components, keep_one_of_each

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def brute(rows):
    """(set size, component as the smallest id) of each row."""
    sets = [shingles(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            lists[x].append(k)
    for k, s in enumerate(sets):
        for j, n in Counter(j for x in s for j in lists[x] if j > k).items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                root[find(j)] = find(k)
    least = {}
    for k, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(doc_id, least.get(find(k), doc_id))
    return [(len(s), least.get(find(k))) for k, s in enumerate(sets)]


def near_copies(seed, groups=3, each=30, length=80, edits=4):
    rng = random.Random(seed)
    rows = []
    for g in range(groups):
        base = [f"w{rng.randrange(400)}g{g}" for _ in range(length)]
        for _ in range(each):
            words = list(base)
            for _ in range(rng.randrange(edits)):
                words[rng.randrange(length)] = f"z{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    common = " ".join(f"c{k}" for k in range(9))
    for _ in range(40):  # short texts around one common passage
        rows.append((len(rows), common + " " + " ".join(f"t{rng.randrange(9)}" for _ in range(rng.randrange(4)))))
    return rows


@pytest.mark.parametrize(("cell_sets", "cell_shingles"), [(3000, 10**6), (12, 900)])
def test_components_against_brute_force(make_docs, cell_sets, cell_shingles):
    rows = near_copies(3)
    got = jaccard_components(make_docs(rows), cell_sets=cell_sets, cell_shingles=cell_shingles).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got}
    assert [found[i] for i, _ in rows] == brute(rows)


def test_threshold_is_met_exactly(make_docs):
    base = [f"w{k}" for k in range(24)]  # 20 shingles
    rows = [(1, " ".join(base)), (2, " ".join(base[:20])), (3, " ".join(base[:19])), (4, " ".join(base).upper())]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(make_docs(rows)).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1}  # 3 reaches 1 through 2 (15 of 16), not directly (15 of 20)
    got = {r["doc_id"]: r["component_id"] for r in jaccard_components(make_docs([rows[0], rows[2]])).collect()}
    assert got == {1: 1, 3: 3}


def test_divide_skip_finds_every_link():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(60):
        base = rng.choice(500, rng.integers(5, 60), replace=False)
        sets.append(np.unique(base))
        for _ in range(3):
            near = base.copy()
            near[: rng.integers(0, max(1, len(base) // 6))] = rng.integers(500, 900)
            sets.append(np.unique(near))
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    label = divide_skip(
        np.concatenate(sets).astype(np.uint64), bounds, np.arange(len(sets)), np.ones(len(sets), bool), 80
    )
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert label[i] == label[j]


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(7, k) for k in range(200, 230)] + [(3, 3), (229, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[k] for k in range(100, 161)} == {100}
    assert {got[k] for k in [5, 7, *range(200, 230)]} == {5}
    assert 3 not in got
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(make_docs, clashing, odd_rows):
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_components(clashing).collect()]
    expected = [(i, n, c if n else i) for (i, *_), (n, c) in zip(odd_rows, brute(odd_rows), strict=True)]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert jaccard_components(make_docs([])).collect() == []


def test_one_of_each_stays(make_docs, clashing, odd_rows):
    rows = near_copies(5)
    kept = keep_one_of_each(make_docs(rows)).collect()
    component = {i: c for (i, _), (_, c) in zip(rows, brute(rows), strict=True)}
    assert sorted(component[r["doc_id"]] for r in kept) == sorted(set(component.values()))
    kept = keep_one_of_each(clashing)
    assert kept.columns == clashing.columns
    # one of the five equal texts, all four without words, and three others
    assert kept.count() == 8
    assert keep_one_of_each(make_docs([])).collect() == []


def test_hot_lists_against_brute_force(make_docs, monkeypatch):
    """Lists that count as hot take the way through aggregates and a join; the answer is the same."""
    monkeypatch.setattr(ngram_join, "HOT_SAMPLE", 1)
    monkeypatch.setattr(ngram_join, "HOT_SEEN", 6)
    rows = near_copies(4, groups=2, each=20)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_components(make_docs(rows)).collect()}
    assert [got[i] for i, _ in rows] == brute(rows)
