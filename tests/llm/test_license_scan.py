import re

from pyspark.sql import functions as F

from weekly_mart.llm.license_rules import GATES, _notices, rules
from weekly_mart.llm.license_scan import BASE, scan_licenses

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TEXTS = [
    "Released under the MIT License. MIT LICENSE, mit  license",
    "mit license mit license general public license apache license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under CC BY-NC 4.0.",
    "Licensed under the Apache License, Version 2.0.",
    "SPDX-License-Identifier: BSD-3-Clause",
    "permit licensee of the summit license",
    "mİt licenſe K license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "é mit-license/é",
    "",
    None,
    "no words of that kind here at all",
]


def brute(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UP, LOW)))
    places = []
    for phrase, label in BASE.items():
        p = phrase.split()
        places += [(k, label) for k in range(len(words) - len(p) + 1) if words[k : k + len(p)] == p]
    return len(words), sorted(places)


def test_base_phrases_against_brute_force(make_docs):
    got = scan_licenses(make_docs(list(enumerate(TEXTS)))).collect()
    for r in got:
        assert (r["n_words"], sorted((p["word"], p["label"]) for p in r["places"])) == brute(TEXTS[r["doc_id"]])


def test_rules_priority_and_containment(make_docs):
    got = {r["doc_id"]: r for r in scan_licenses(make_docs(list(enumerate(TEXTS)))).collect()}
    labels = {k: sorted({d["label"] for d in r["found"]}) for k, r in got.items()}
    assert labels[2] == ["gpl-3.0"] and labels[3] == ["cc-by-nc-4.0"] and labels[4] == ["apache-2.0"]
    assert labels[5] == ["bsd-3-clause"] and labels[6] == [] and labels[8] == ["mit"]
    # the grant holds the bare name: one detection, over the words "licensed ... 3"
    grant = got[2]["found"]
    assert len(grant) == 1 and (grant[0]["first_word"], grant[0]["last_word"], grant[0]["priority"]) == (3, 11, 1)
    assert got[2]["score"] == 0.9 and got[12]["score"] == got[11]["score"] == 0


def test_there_are_hundreds_of_rules_and_each_compiles():
    table = rules()
    assert len(table) > 200
    for r in table:
        re.compile(r.pattern)


def test_every_keyword_is_part_of_what_its_rule_matches(make_docs):
    # a rule's text form, built from its own label family, is found through its keyword
    docs = make_docs([(0, "SPDX-License-Identifier: MPL-2.0"), (1, "licensed under the Mozilla Public License 2.0"),
                      (2, "released into the public domain"), (3, "distributed under the terms of the EPL version 2.0")])
    got = {r["doc_id"]: {d["label"] for d in r["found"]} for r in scan_licenses(docs).collect()}
    assert got == {0: {"mpl-2.0"}, 1: {"mpl-2.0"}, 2: {"public-domain"}, 3: {"epl-2.0"}}


def test_odd_rows(make_docs, clashing, odd_rows):
    assert scan_licenses(clashing).count() == len(odd_rows)
    assert scan_licenses(make_docs([])).collect() == []
    many = make_docs([(1, "the mit license " * 3000)])
    r = scan_licenses(many).select(F.size("places"), F.size("found")).first()
    assert r[0] == 3000 and r[1] == 3000


def sentences(pattern):
    """Texts a pattern matches, in which every alternative of it is taken once."""
    from re import _parser

    def series(items):
        parts = [one(*i) for i in items]
        out = ["".join(p[0] for p in parts)]
        for k, p in enumerate(parts):
            out += ["".join(q[0] for q in parts[:k]) + v + "".join(q[0] for q in parts[k + 1 :]) for v in p[1:]]
        return out

    def one(op, arg):
        name = str(op)
        if name == "LITERAL":
            return [chr(arg)]
        if name == "IN":
            return [chr(c) for _, c in arg]
        if name == "BRANCH":
            return [v for b in arg[1] for v in series(b)]
        if name == "SUBPATTERN":
            return series(arg[3])
        assert name == "MAX_REPEAT" and arg[:2] == (0, 1)
        return ["", *series(arg[2])]

    return series(_parser.parse(pattern))


def test_every_alternative_of_a_rule_holds_a_keyword_and_a_gate():
    for r in rules():
        for text in sentences(r.pattern):
            assert re.fullmatch(r.pattern, text)
            norm = f" {text.replace(' ', '  ')} "
            assert any(k in norm for k in r.keywords), (r, text)
            assert any(g.split(" ")[0] in text for g in GATES), (r, text)


def test_labels_do_not_depend_on_other_words(make_docs):
    texts = {
        "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
        "under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License": "cc-by-nc-sa-3.0",
        "licensed under the Expat license": "mit", "CDDL license": "cddl-1.0", "EUPL licensed": "eupl-1.2",
        "licensed under the PSF license": "python-2.0", "licensed under the WTFPL": "wtfpl",
        "released under the ODbL": "odbl-1.0", "released under Creative Commons Zero": "cc0-1.0", "provided as is": "no-warranty",
    }
    got = scan_licenses(make_docs(list(enumerate(texts)))).collect()
    for r in got:
        text, label = list(texts.items())[r["doc_id"]]
        assert label in {d["label"] for d in r["found"]}, text


def test_many_hits_in_one_text(spark):
    """Offsets over many blocks of hits, and a time that does not grow with their square."""
    n = 9_000
    text = F.repeat(F.lit("mit license and the Apache License x "), n)
    (r,) = scan_licenses(spark.range(1).select(F.lit(1).alias("doc_id"), text.alias("text"))).collect()
    assert r["n_words"] == 7 * n
    words = {label: [p["word"] for p in r["places"] if p["label"] == label] for label in BASE.values()}
    assert words == {"mit": list(range(0, 7 * n, 7)), "apache": list(range(4, 7 * n, 7)), "gpl": []}
    assert sorted((d["first_word"], d["last_word"], d["label"]) for d in r["found"]) == sorted(
        [(7 * k, 7 * k + 1, "mit") for k in range(n)] + [(7 * k + 4, 7 * k + 5, "apache") for k in range(n)]
    )


def test_each_notice_is_found_whole_and_not_with_a_word_changed(make_docs):
    notices = _notices()
    assert len(notices) > 60
    texts, wanted = [], []
    for r in notices:
        for text in sentences(r.pattern)[:4]:
            words = text.split(" ")
            near = [*words[: len(words) // 2], "otherword", *words[len(words) // 2 + 1 :]]
            texts += [f"Before, {text.capitalize()}; after.", " ".join(near)]
            wanted += [(r, text, True), (r, " ".join(near), False)]
    numbered = {rule: k for k, rule in enumerate(rules())}
    got = {r["doc_id"]: r for r in scan_licenses(make_docs(list(enumerate(texts)), parts=8)).collect()}
    for k, (rule, text, whole) in enumerate(wanted):
        found = {d["rule"] for d in got[k]["found"]}
        if not whole:
            assert numbered[rule] not in found, text
        elif numbered[rule] not in found:  # only a longer notice may stand over it
            assert any(d["first_word"] <= 1 and d["last_word"] >= len(text.split()) for d in got[k]["found"]), text
