import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weekly_mart.llm.decontaminate import fingerprints, shared_passages, words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def split(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(doc, items, span):
    """Spans of hit words and the items found, by looking for every window at every place."""
    w, hit, found = split(doc), set(), set()
    for item, text in items:
        b = split(text)
        n = min(span, len(b))
        wins = {tuple(b[k : k + n]) for k in range(len(b) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in wins:
                hit.update(range(k, k + n))
                found.add(item)
    return len(w), len(hit), sorted(str(x) for x in found if x is not None)


def answers(spark, docs, items, **options):
    bench = spark.createDataFrame(items, ITEM)
    out = shared_passages(docs, bench, **options).collect()
    return [
        (r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["items"]) for r in out
    ]


@pytest.fixture(scope="module")
def planted():
    """Texts over few words, with items' passages, copies, repeats and short items."""
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "Cé", "d1", "E", "f"])
    sep = lambda: rng.choice([" ", ", ", "\n", "\x00", "--"])
    make = lambda n: "".join(word() + sep() for _ in range(n))
    items = [(k, make(rng.randint(8, 40))) for k in range(12)]
    items += [(20, "zeta omega"), (21, "zeta omega"), (21, "nu"), (22, ""), (23, None), (None, make(15)), (24, "a " * 30)]
    docs = []
    for k in range(60):
        parts = [make(rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            item = rng.choice(items)[1] or ""
            cut = item.split(" ")
            a = rng.randint(0, len(cut))
            parts += [" ".join(cut[a : a + 14]).upper(), make(rng.randint(0, 9))]
        docs.append((k, " ".join(parts)))
    docs += [(60, "a " * 200), (61, "b " + "a " * 9), (62, docs[3][1]), (None, docs[3][1]), (63, "the ZETA, omega."), (64, "nu"), (65, "nothing shared here")]
    return docs, items


@pytest.mark.parametrize("rows", [0, 1_000_000])  # joined by shuffle, and by broadcast
@pytest.mark.parametrize("span", [10, 7, 3])
def test_against_every_window_at_every_place(spark, make_docs, planted, rows, span):
    docs, items = planted
    found = answers(spark, make_docs(docs), items, span=span, broadcast_rows=rows)
    expected = [(d, *brute(text, items, span)) for d, text in docs]
    assert sorted(found, key=str) == sorted(expected, key=str)
    assert any(n for *_, n in found) and any(not n for *_, n in found)


@pytest.mark.parametrize("span", [1, 2, 5, 10, 13])
def test_equal_runs_share_a_fingerprint(spark, span):
    rng = random.Random(span)
    for alphabet in (1, 2, 50):
        run = [f"w{rng.randrange(alphabet)}" for _ in range(span)]
        texts = [
            " ".join([f"w{rng.randrange(alphabet)}" for _ in range(k)] + run + ["w0"] * (9 - k)) for k in range(8)
        ]
        df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
        rows = df.select("k", fingerprints(words(F.col("text")), span).alias("p")).collect()
        width = span - (span + 1) // 2 + 1
        # each text names, for the run that starts at k, a fingerprint at most width - 1 windows before it
        common = [{p["hash"] for p in r["p"] if r["k"] - width < p["at"] <= r["k"]} for r in rows]
        assert set.intersection(*common)


def test_odd_rows_and_clashing_columns(spark, make_docs, odd_rows, clashing):
    items = [(1, "beta gamma delta epsilon zeta"), (2, "ÜNïcödé nothing"), (3, "67890")]
    expected = sorted(((d, *brute(text, items, 10)) for d, text, *_ in odd_rows), key=str)
    assert sorted(answers(spark, make_docs(odd_rows), items), key=str) == expected
    more = clashing
    for name in ("words", "k1", "k2", "prints", "span", "spans", "items", "id", "at", "start", "_1", "item", "window"):
        more = more.withColumn(name, F.lit("x"))
    assert sorted(answers(spark, more, items), key=str) == expected


def test_empty_tables(spark, make_docs):
    docs = make_docs([(1, "some words"), (2, None)])
    assert sorted(answers(spark, docs, [])) == [(1, 2, 0, []), (2, 0, 0, [])]
    assert answers(spark, docs.where("false"), [(1, "some words")]) == []


def test_no_python_in_the_plan(spark, make_docs):
    out = shared_passages(make_docs([(1, "some words")]), spark.createDataFrame([(1, "some words")], ITEM))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
