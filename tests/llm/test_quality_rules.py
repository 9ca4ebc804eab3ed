import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from weekly_mart.llm.quality_rules import fit, quality

PROSE = " ".join(f"Sentence number {chr(97 + i % 26)}{i} says another{i} thing about river{i * 7}." for i in range(20))


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, copies = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, copies, len(covered)


def test_counts_against_brute_force(make_docs, odd_rows):
    texts = [r[1] for r in odd_rows] + [
        "a b c a b c a", "x\nx\n \n\ny\nx", "é ü é ü é ü", "#1 |2| <3>\r\nend", "one\x0btwo\x0cthree", "a  b\n a  b\na  b", PROSE,
    ]
    got = quality(make_docs(list(enumerate(texts)))).collect()
    for r in got:
        counts = (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
        assert counts == brute(texts[r["doc_id"]]), texts[r["doc_id"]]


def test_clean_texts_stay_and_junk_goes(make_docs):
    clean = [(i, PROSE.replace("river", f"lake{i}")) for i in range(60)]
    symbols = [(100 + i, " ".join(f"w{i}{k}### $$$" for k in range(80))) for i in range(6)]
    shouting = [(200 + i, " ".join(f"LOUD{i}X{k}!!" for k in range(80))) for i in range(4)]
    got = {r["doc_id"]: r["kept"] for r in quality(make_docs(clean + symbols + shouting)).collect()}
    assert all(got[i] for i, _ in clean)
    assert not any(got[i] for i, _ in symbols + shouting)


def test_fit_finds_the_accuracies_that_made_the_votes():
    rng = np.random.default_rng(1)
    good = rng.random(40_000) < 0.85
    right = [0.97, 0.9, 0.95]
    patterns = np.full((len(good), 4), -1)
    for k in range(3):  # defect rules, which fire on half of the bad texts and by mistake on good ones
        share = 0.5 * 0.15 * (1 - right[k]) / right[k] / 0.85
        patterns[(~good & (rng.random(len(good)) < 0.5)) | (good & (rng.random(len(good)) < share)), k] = 0
    patterns[good & (rng.random(len(good)) < 0.9), 3] = 1
    seen, n = np.unique(patterns, axis=0, return_counts=True)
    share, accuracy = fit(seen, n.astype(float))
    assert abs(share - 0.85) < 0.06
    # the beliefs weigh as much as the data and pull towards 0.95
    assert all(abs(a - b) < 0.08 for a, b in zip(accuracy, [*right, 1.0], strict=True))


def test_odd_rows(make_docs, clashing, odd_rows):
    got = quality(clashing)
    assert got.count() == len(odd_rows)
    assert got.where("doc_id IS NULL").count() == 2
    assert quality(make_docs([])).collect() == []
    assert got.where(F.col("n_words") == 0).select("word_chars").distinct().collect()[0][0] == 0
