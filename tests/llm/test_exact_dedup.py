import hashlib
from collections import defaultdict

from weekly_mart.llm.exact_dedup import drop_copies, exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((doc_id, keep, len(ids), doc_id == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return out


def as_rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_all_rows_against_brute_force(make_docs, odd_rows):
    rows = odd_rows + [(100 + i, "x" * (i % 4) + "tail", None, None) for i in range(40)]
    same_prefix = [(200 + i, "p" * 300 + str(i % 3), None, None) for i in range(9)]
    got = as_rows(exact_dedup(make_docs(rows + same_prefix), digest_col="sha"))
    assert got == sorted(brute(rows + same_prefix), key=repr)


def test_without_digest_gives_the_same_groups(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    with_digest = exact_dedup(docs, digest_col="sha").drop("sha")
    assert as_rows(exact_dedup(docs)) == as_rows(with_digest)


def test_drop_copies_leaves_one_row_of_each_text(clashing, odd_rows):
    kept = drop_copies(clashing)
    assert kept.columns == clashing.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t, *_ in odd_rows})


def test_empty_table_and_clashing_columns(make_docs, clashing, odd_rows):
    assert exact_dedup(make_docs([]), digest_col="sha").collect() == []
    assert drop_copies(make_docs([])).collect() == []
    assert exact_dedup(clashing).count() == len(odd_rows)
