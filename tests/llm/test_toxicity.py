import math
import random
import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from weekly_mart.llm.common import unit
from weekly_mart.llm.toxicity import (
    LEARNED_ODDS,
    LEARNED_TEXTS,
    LEXICON,
    NAMES,
    SECOND_PERSON,
    _margin,
    features,
    fit_toxicity,
    score_toxicity,
    text_features,
    words_of,
)


def labelled(n, seed):
    rng = random.Random(seed)
    words = [f"word{k}" for k in range(300)]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 80))
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randrange(1, 5)):
                text.insert(rng.randrange(len(text)), rng.choice(["you idiot", "moron", "grumblix"]))
        rows.append((i, " ".join(text), int(toxic)))
    return rows


def test_features():
    f = dict(zip(NAMES, features("You IDIOT!! id1ot and grumblix are sooooo bad", frozenset({"grumblix"})), strict=True))
    assert f["any_lexicon"] == 3 and f["distinct_lexicon"] == 2
    assert f["d_insult"] > 0 and f["d_learned"] > 0 and f["near_you"] > 0 and f["obfuscated"] > 0
    assert f["stretched"] > 0 and f["shouted"] > 0 and f["exclamations"] > 0
    assert features("", frozenset()) == [0.0] * len(NAMES)


def test_held_out_accuracy_and_odd_rows(spark, clashing, make_docs, odd_rows):
    train = spark.createDataFrame(labelled(800, 1), "doc_id long, text string, toxic int")
    model = fit_toxicity(train, trees=8)
    assert "grumblix" in model.learned
    held = labelled(400, 2)
    scored = score_toxicity(spark.createDataFrame(held, "doc_id long, text string, toxic int"), model)
    got = {r["doc_id"]: r["score"] for r in scored.collect()}
    assert all(0 <= s <= 1 for s in got.values())
    assert np.mean([(got[i] >= 0.7) == bool(y) for i, _, y in held]) > 0.97
    assert score_toxicity(clashing, model).count() == len(odd_rows)
    assert score_toxicity(make_docs([]), model).collect() == []


def test_one_class_or_no_labels(spark, make_docs):
    for rows, expected in (([], 0.0), ([(1, "a", 1), (2, "b", 1)], 1.0), ([(1, "a", None)], 0.0)):
        model = fit_toxicity(spark.createDataFrame(rows, "doc_id long, text string, toxic int"))
        assert score_toxicity(make_docs([(1, "x"), (2, None)]), model).select("score").distinct().first()[0] == expected


def naive_features(text, learned):
    """Every feature by its definition, one at a time, over the words as they are written."""
    raw = re.findall(r"[^\W_]+(?:[@$!*'][^\W_]+)*", text)
    words = [w.lower() for w in raw]
    if not words:
        return [0.0] * len(NAMES)
    n = len(words)
    leet = dict(zip("013457@$!", "oieastasi", strict=True))
    plain = [w if len(w) == 1 or w.isalpha() else "".join(leet.get(c, c) for c in w) for w in words]
    kind_of = {w: k for k, listed in LEXICON.items() for w in listed.split()}
    hits = [k for k, w in enumerate(plain) if w in kind_of or w in learned]
    masked = sum(len(w) > 1 and re.match(r"[^\W\d_]+[@$!*\d]+[^\W_]", w) is not None for w in words)
    alone = "".join("x" if len(w) == 1 else " " for w in words).split()
    masked += sum(len(run) >= 4 for run in alone)
    out = {f"d_{k}": sum(kind_of.get(plain[i]) == k for i in hits) / n for k in LEXICON}
    out["d_learned"] = sum(plain[i] in learned for i in hits) / n
    out["any_lexicon"], out["distinct_lexicon"] = len(hits), len({plain[i] for i in hits})
    out["near_you"] = sum(any(abs(i - j) <= 4 and words[j] in SECOND_PERSON for j in range(n)) for i in hits) / n
    out["second_person"] = sum(w in SECOND_PERSON for w in words) / n
    capital = [c for c in text if "A" <= c <= "Z" or "À" <= c <= "Ö" or "Ø" <= c <= "Þ"]
    out["capitals"] = len(capital) / sum(len(w) for w in raw)
    out["shouted"] = sum(len(w) > 2 and w == w.upper() and w != w.lower() for w in raw) / n
    out["exclamations"] = sum(c in "!?" for c in text) / n
    out["punctuation"] = sum(c in "!?.,;:" for c in text) / n
    out["obfuscated"] = masked / n
    out["stretched"] = len(re.findall(r"(\w)\1\1\1", text)) / n
    out["log_words"] = math.log(n + 1)
    return [float(out[k]) for k in NAMES]


def test_features_against_a_naive_count(spark):
    rng = random.Random(6)
    parts = ["you", "Your", "IDIOT", "id1ot", "f*ck", "sh!t", "stu-pid", "a", "b", "c", "d", "e", "noooo", "Über", "grumblix",
             "word", "kill", "dich", "hello_there", "x1", "WORD9", "!!", "?", "...", ";", "1234", "É", "ñ", "\n", "don't", "m0r0n"]
    texts = [" ".join(rng.choices(parts, k=rng.randrange(0, 40))) for _ in range(300)] + ["", "   ", "!!!", "a b c d e f", "you " * 5000]
    learned = frozenset({"grumblix", "kill", "word"})
    for t in texts:
        assert features(t, learned) == pytest.approx(naive_features(t, learned), rel=1e-12), t
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").where("length(text) < 4000")
    rows = text_features(docs, sorted(learned), text_col="text", keep=["doc_id"]).collect()
    by_id = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in rows:
        assert [r[k] for k in NAMES] == pytest.approx(naive_features(by_id[r["doc_id"]] or "", learned), rel=1e-12)


def pooled(points):
    """Isotonic fit by pooling neighbours that fall: value of each margin."""
    grouped = {}
    for x, y in points:
        grouped.setdefault(x, []).append(y)
    blocks = []  # margins, sum, count
    for x in sorted(grouped):
        blocks.append([[x], sum(grouped[x]), len(grouped[x])])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2] + last[2]]
    return {x: total / n for xs, total, n in blocks for x in xs}


def test_lexicon_and_isotonic_step_against_brute_force(spark):
    rows = labelled(600, 5)
    rows = [(i, t, y if k % 17 else 1 - y) for k, (i, t, y) in enumerate(rows)]  # some labels are wrong
    df = spark.createDataFrame(rows + rows[:50] * 3, "doc_id long, text string, toxic int")  # copies count once
    model = fit_toxicity(df, trees=6)
    tagged = df.dropDuplicates(["doc_id"]).withColumn("_part", unit("text", seed=8))
    train = [(r["text"], r["toxic"]) for r in tagged.where("_part < 0.8").collect()]
    size = {y: sum(b == y for _, b in train) for y in (0, 1)}
    odds = {}
    for w in {w for t, _ in train for w in words_of(t)}:
        yes, no = (sum(b == y and w in set(words_of(t)) for t, b in train) for y in (1, 0))
        if yes >= LEARNED_TEXTS:
            odds[w] = (math.log((yes + 0.5) / (size[1] + 1)) - math.log((no + 0.5) / (size[0] + 1)), yes)
    expected = {w for w, (o, _) in odds.items() if o >= LEARNED_ODDS}
    assert set(model.learned) == expected and "grumblix" in expected
    held = text_features(tagged.where("_part >= 0.8").withColumnRenamed("toxic", "_toxic"), model.learned,
                         text_col="text", keep=["_toxic"])
    margins = _margin(model.trees, VectorAssembler(inputCols=NAMES, outputCol="_features").transform(held))
    steps = model.calibration.transform(margins).select("_margin", "_toxic", "_step").collect()
    fitted = pooled([(r["_margin"], r["_toxic"]) for r in steps])
    assert len(set(fitted.values())) > 1
    for r in steps:
        assert r["_step"] == pytest.approx(fitted[r["_margin"]], abs=1e-9)


def test_labels_in_a_table_of_their_own_meet_ids_and_hashes_only(spark):
    import contextlib
    import io
    from unittest import mock

    from weekly_mart.llm import toxicity

    texts = [("you stupid worthless idiot " if k % 3 == 0 else "a calm and friendly walk ") + f"number {k % 400}" for k in range(900)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(None, "x"), (901, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(850)] + [(901, 0), (5, 7)], "doc_id long, toxic int")
    plans = []
    write = toxicity.materialise

    def seen(df, name):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            df.explain()
        plans.append((name, out.getvalue()))
        return write(df, name)

    with mock.patch.object(toxicity, "materialise", seen):
        apart = toxicity.fit_toxicity(docs, labels=labels, trees=3)
    joined = toxicity.fit_toxicity(docs.join(labels, "doc_id"), trees=3)
    assert apart.learned == joined.learned
    marks = dict(plans)["toxic-parts"]
    assert "Join" in marks and not [x for x in marks.splitlines() if "Exchange" in x and "text" in x.split("plan_id")[0]]
    scores = [{r.doc_id: r.score for r in toxicity.score_toxicity(docs, m).collect()} for m in (apart, joined)]
    assert all(abs(scores[0][k] - scores[1][k]) < 1e-9 for k in scores[0])
