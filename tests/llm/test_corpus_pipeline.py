from collections import Counter

import duckdb
import pytest
from test_ngram_join import brute

import corpus_pipeline
from weekly_mart.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"


def test_stages_against_simple_rules(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "ngram_jaccard", "mixing", "best_fit_packing"]
    path = corpus_pipeline.scratch_root(spark)
    kept = []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = f"{path}/stage-test-{id(docs)}-{number}"
        stage(spark, docs, SF).write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "best_fit_packing":
            assert docs.columns == columns
        kept.append(docs.collect())
    first, second, third, fourth, last = kept
    assert all(any(c.isalpha() for c in r["text"]) for r in first)
    by_text = {}
    for r in first:
        by_text[r["text"]] = max(r["doc_id"], by_text.get(r["text"], -1))
    assert sorted(r["doc_id"] for r in second) == sorted(by_text.values())
    # one row of each component that brute force finds among the rows of the stage before
    rows = [(r["doc_id"], r["text"]) for r in second]
    component = {i: c for (i, _), (_, c) in zip(rows, brute(rows), strict=True)}
    assert sorted(component[r["doc_id"]] for r in third) == sorted(set(component.values()))
    assert len(third) < len(second)
    assert {r["doc_id"] for r in fourth} == {r["doc_id"] for r in third}
    assert max(Counter(r["doc_id"] for r in fourth).values()) <= 2
    assert sum(r["size"] for r in last) == sum(len(r["text"].split()) for r in fourth)


def test_run_and_registry(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries())
    assert numbers == list(range(1, 14))
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_duckdb(spark, name):
    found = queries()[name](spark, SF)
    con = duckdb.connect()
    for view in ("documents", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {view} AS SELECT * FROM read_parquet('{SF}/{view}.parquet')")
    con.execute(f"CREATE VIEW o0 AS {oracle_sql()[name]}")
    twin = con.sql("SELECT * FROM o0")
    columns = sorted(found.columns)
    assert columns == sorted(twin.columns)
    order = [twin.columns.index(c) for c in columns]
    expected = sorted(tuple(r[k] for k in order) for r in twin.fetchall())
    assert sorted(tuple(r) for r in found.select(columns).collect()) == expected
