import math
import random
from collections import Counter, defaultdict

import numpy as np

from weekly_mart.llm.language_id import ORDER, LanguageModel, identify_language, keep_identified, learn_languages

WORDS = {
    "en": "the of and to in that with this from have not but water house time people".split(),
    "de": "der die und nicht mit das ist ein auch wasser haus zeit für über leute".split(),
    "fr": "le la et les des une est pas pour avec dans eau maison temps où été".split(),
}


def corpus(n, seed):
    rng = random.Random(seed)
    return [
        (i, " ".join(rng.choices(WORDS[lang], k=rng.randrange(8, 40))), lang, "s")
        for i, lang in ((i, rng.choice(list(WORDS))) for i in range(n))
    ]


def naive_bits(text, texts):
    """Code length of one text under the tree learned from ``texts``, method C, byte by byte."""
    counts = defaultdict(Counter)
    for t in texts:
        data = t.encode()
        for i, x in enumerate(data):
            for k in range(min(i, ORDER) + 1):
                counts[data[i - k : i]][x] += 1

    def p(context, x):
        c = counts.get(context)
        shorter = p(context[1:], x) if context else 1 / 256
        if not c:
            return shorter
        n, kinds = sum(c.values()), len(c)
        return c[x] / (n + kinds) if c[x] else kinds / (n + kinds) * shorter

    data = text.encode()
    return sum(-math.log2(p(data[max(0, i - ORDER) : i], x)) for i, x in enumerate(data))


def test_code_lengths_against_a_naive_tree(spark, make_docs):
    rows = corpus(40, 1)
    model = learn_languages(make_docs(rows), sample_docs=10**6)
    tables = model.tables()
    tests = ["the water und die zeit", "où été le temps", "zzz", "x", "das Wasser ist über"]
    data = "".join(tests).encode()
    bounds = np.cumsum([0] + [len(t.encode()) for t in tests])
    bits = tables.code_lengths(np.frombuffer(data, np.uint8), bounds)
    for k, text in enumerate(tests):
        for j, lang in enumerate(model.langs):
            expected = naive_bits(text, [t for _, t, x, _ in rows if x == lang])
            assert abs(bits[k, j] - expected) < 0.01 * expected + 0.01, (text, lang)


def test_held_out_accuracy(make_docs):
    model = learn_languages(make_docs(corpus(150, 2)))
    held = corpus(150, 3)
    got = {r["doc_id"]: r for r in identify_language(make_docs(held), model).collect()}
    assert np.mean([got[i]["lang_pred"] == lang for i, _, lang, _ in held]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_undetermined_and_odd_rows(make_docs, clashing, odd_rows):
    model = learn_languages(make_docs(corpus(60, 4)))
    got = identify_language(clashing, model).collect()
    assert len(got) == len(odd_rows)
    pred = {r["doc_id"]: r["lang_pred"] for r in got}
    assert pred[3] == pred[4] == pred[5] == pred[8] == "und"
    assert pred[7] in WORDS and pred[6] in WORDS
    kept = keep_identified(clashing, model)
    assert kept.columns == clashing.columns and kept.count() == 6
    assert identify_language(make_docs([]), model).collect() == []
    # other scripts count as letters
    other = identify_language(make_docs([(1, "Привет"), (2, "…—…")]), model).collect()
    assert sorted((r["doc_id"], r["lang_pred"] == "und") for r in other) == [(1, False), (2, True)]


def test_nothing_to_learn_from(make_docs):
    model = learn_languages(make_docs([(1, "text", None, None), (2, None, "en", None)]))
    assert isinstance(model, LanguageModel) and model.langs == []
    assert identify_language(make_docs([(1, "some words")]), model).first()["lang_pred"] == "und"


def test_trees_are_compiled_in_little_more_than_their_own_size():
    import tracemalloc

    import numpy as np

    from weekly_mart.llm.language_id import LanguageModel

    rng = np.random.default_rng(5)
    data = rng.choice(np.arange(97, 121), 60_000).astype(np.int64)
    gram, size, count = [], [], []
    run = np.zeros(len(data), np.int64)
    for k in range(1, 5):
        n = len(data) - k + 1
        run = (run[:n] << 8) | data[k - 1 :]
        found, times = np.unique(run, return_counts=True)
        gram.append(found), size.append(np.full(len(found), k)), count.append(times)
    langs = [f"l{k}" for k in range(12)]
    copies = [np.concatenate(x) for x in (size, gram, count)]
    model = LanguageModel(
        langs, np.repeat(np.arange(12), len(copies[0])), *[np.tile(x, 12).astype(np.int64) for x in copies]
    )
    tracemalloc.start()
    tables = model.tables()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    own = tables.bits.nbytes + tables.child.nbytes
    assert peak < 3 * own + 16 * model.gram.nbytes / 4, (peak, own)


def test_workers_get_small_batches_and_scan_in_small_chunks(make_docs):
    import tracemalloc

    import pyarrow as pa

    from weekly_mart.llm.ngram_join import shingle_sets
    from weekly_mart.llm.textscan import chunks

    docs = make_docs(corpus(3500, 6), parts=1)
    spark = docs.sparkSession
    names = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = {name: spark.conf.get(name, None) for name in names}
    try:
        for name in names:
            spark.conf.unset(name)
        model = learn_languages(docs)
        identify_language(docs, model)
        sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n long")
        assert max(r["n"] for r in sizes.collect()) <= 1000
        spark.conf.set(names[0], "10")  # a lower limit stays
        identify_language(docs, model)
        assert spark.conf.get(names[0]) == "10"
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    # what is sent to the workers holds the same model in fewer bytes
    sent = model.narrow()
    assert sum(x.nbytes for x in sent[1:]) <= 0.5 * sum(x.nbytes for x in (model.lang, model.size, model.gram, model.count))
    again = LanguageModel.widened(*sent)
    assert all((getattr(again, x) == getattr(model, x)).all() for x in ("lang", "size", "gram", "count"))

    text = pa.array([" ".join(f"w{(k * j) % 9973}" for j in range(300)) for k in range(2000)])
    tracemalloc.start()
    for c in chunks(text):
        shingle_sets(c, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24e6, peak
