"""Operators that hand on whole rows get a column for every name their modules use, and give all of them back."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from weekly_mart.llm import common, components, exact_dedup, language_id, ngram_join, shuffle_shards, temperature_mix
from weekly_mart.llm.exact_dedup import drop_copies
from weekly_mart.llm.language_id import keep_identified, learn_languages
from weekly_mart.llm.ngram_join import keep_one_of_each
from weekly_mart.llm.shuffle_shards import shard_rows
from weekly_mart.llm.temperature_mix import repeat_to_weights

OWN = ("doc_id", "text", "lang", "source", "n_chars")


def names(*modules):
    """Every string of the modules' sources that can be a column name."""
    found = set()
    for m in (common, *modules):
        for text in re.findall(r'"([^"\n]*)"', Path(m.__file__).read_text()):
            found.update(re.findall(r"[A-Za-z_]\w*", text))
    return sorted({n.lower() for n in found} - set(OWN))


@pytest.mark.parametrize(("operator", "modules", "least"), [
    (drop_copies, (exact_dedup,), 6),
    (keep_one_of_each, (ngram_join, components), 8),
    (repeat_to_weights, (temperature_mix,), 11),
    (lambda d: shard_rows(d).drop("shard", "slot"), (shuffle_shards,), 11),
    (lambda d: keep_identified(d, learn_languages(d)), (language_id,), 5),
])
def test_columns_of_any_name_come_back(make_docs, odd_rows, operator, modules, least):
    extra = [n for n in names(*modules) if n not in ("shard", "slot")]
    assert len(extra) > 20
    docs = make_docs(odd_rows).select("*", *[F.concat(F.lit(n + "/"), F.coalesce("text", F.lit("")).substr(1, 9)).alias(n) for n in extra])
    out = operator(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) >= least
    known = {(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in make_docs(odd_rows).collect()}
    for r in rows:
        assert tuple(r[c] for c in OWN) in known
        assert all(r[n] == f"{n}/{(r['text'] or '')[:9]}" for n in extra)
