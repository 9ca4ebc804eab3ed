"""The registered queries of this subpackage, and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weekly_mart.llm.best_fit_packing import pack
from weekly_mart.llm.common import table
from weekly_mart.llm.decontaminate import shared_passages
from weekly_mart.llm.exact_dedup import exact_dedup
from weekly_mart.llm.html_extract import extract_text
from weekly_mart.llm.language_id import identify_language, learn_languages
from weekly_mart.llm.license_scan import scan_licenses
from weekly_mart.llm.ngram_join import jaccard_components
from weekly_mart.llm.prefix_trie import prefix_trie
from weekly_mart.llm.quality_rules import quality
from weekly_mart.llm.shuffle_shards import shard_rows
from weekly_mart.llm.temperature_mix import mix_sources
from weekly_mart.llm.toxicity import fit_toxicity, score_toxicity
from weekly_mart.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), digest_col="text_sha256")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    return shard_rows(narrow, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        "slot", F.lit(None).cast("int").alias("grown_shard"),
    )

def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality(table(spark, sf_dir, "documents"))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & F.col("kept")).alias("kept"), "posterior",
    )

def _fold() -> Column:
    """Remainder that says which documents are held out (1) and which may be learned from."""
    return F.crc32(F.col("doc_id").cast("string")) % 3


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_languages(docs, usable=_fold() != 1)
    return identify_language(docs, model).withColumn("held_out", F.coalesce(_fold() == 1, F.lit(False)))

def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))

def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))

def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_licenses(table(spark, sf_dir, "documents"))
    words = F.transform("places", lambda p: p.word)
    base = F.array_distinct(F.transform("places", lambda p: p.label))
    both = F.array_union(base, F.transform("found", lambda d: d.label))
    return scanned.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(F.array_sort(base), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"), "score",
    )

def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs.where(_fold() != 1), labels=labels)
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", F.coalesce(_fold() == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )

def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), max_repeats=2.0)

def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), capacity=2048)

def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    shared = shared_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, p: n + p.end - p.start)
    return shared.select(
        "doc_id", "n_words", covered.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_component = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return whiten(table(spark, sf_dir, "embeddings")).select(
        "vec_id", "n", "deviation", "identity_error", by_component
    ).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "c.whitened", "c.explained",
        "identity_error",
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op7_sharding": op7_sharding,
    "op5_quality_rules": op5_quality_rules,
    "op9_language_id": op9_language_id,
    "op6_ngram_jaccard": op6_ngram_jaccard,
    "op10_html_extraction": op10_html_extraction,
    "op2_license_scan": op2_license_scan,
    "op8_toxicity": op8_toxicity,
    "op4_mixing": op4_mixing,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_decontamination": op13_decontamination,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
    """,
    "op6_ngram_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), s AS MATERIALIZED (
            SELECT DISTINCT doc_id, hash(sh) AS sh FROM (
                SELECT doc_id, unnest(CASE WHEN len(ws) >= 5
                    THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS sh FROM w)
        ), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        l AS MATERIALIZED (
            SELECT x, y FROM (
                SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
                GROUP BY 1, 2) p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
            WHERE 100 * i >= 80 * (nx.n + ny.n - i)
        ), e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.c AS component_id FROM documents d
        LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) m ON m.doc_id = d.doc_id
    """,
    "op11_prefix_trie": r"""
        WITH t AS (
            SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
            WHERE conv_id IS NOT NULL
        ), s AS (
            SELECT c, turn, sha256(length(r) || ':' || r || x) AS id,
                   len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM t
        ), o AS (
            SELECT c, list(struct_pack(id := id, w := w) ORDER BY turn NULLS FIRST, id) AS ts,
                   CAST(xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
                       list_transform(range(1, length(CAST(c AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(c AS VARCHAR)[i]) AS BIGINT))),
                       lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda z: CAST(0 AS BIGINT))),
                           lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, CAST(3988292384 AS BIGINT)) ELSE y >> 1 END)),
                       CAST(4294967295 AS BIGINT)) % 4 AS BIGINT) AS h
            FROM s GROUP BY c
        ), p AS (
            SELECT o.c, list_concat(coalesce(b.ts[1:o.h], []), o.ts[o.h + 1:]) AS ts
            FROM o LEFT JOIN o b ON b.c = o.c - o.c % 20
        ), m AS MATERIALIZED (
            SELECT c, d, sha256(array_to_string(list_transform(ts[1:d], lambda u: u.id), '|')) AS k,
                   sha256(array_to_string(list_transform(ts[1:d - 1], lambda u: u.id), '|')) AS pk,
                   CASE WHEN d > 0 THEN ts[d].w ELSE 0 END AS w, d = len(ts) AS ends
            FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM p)
        ), n AS MATERIALIZED (
            SELECT d, k, min(pk) AS pk, min(c) AS c, count(*) AS n, max(w) AS w,
                   sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ends), '')) AS ends
            FROM m GROUP BY d, k
        ), f AS (
            SELECT n.*, (SELECT count(*) FROM n q WHERE q.d = n.d + 1 AND q.pk = n.k) AS n_children FROM n
        ), g AS MATERIALIZED (SELECT * FROM f),
        below AS (
            SELECT DISTINCT a.d, a.k, b.d AS bd, b.k AS bk FROM m a JOIN m b ON a.c = b.c AND b.d >= a.d
        ), sums AS (
            SELECT below.d, below.k, sum((u.n - 1) * u.w) AS saved, count(*) FILTER (u.n_children = 0) AS leaves
            FROM below JOIN g u ON u.d = below.bd AND u.k = below.bk GROUP BY below.d, below.k
        )
        SELECT g.c AS conv_id, g.d AS depth, up.c AS parent_conv_id, g.n AS n_convs, g.n_children,
               sums.leaves AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, g.ends AS ends_sha256
        FROM g JOIN sums USING (d, k) LEFT JOIN g up ON up.d = g.d - 1 AND up.k = g.pk
    """,
    "op13_decontamination": r"""
        WITH d AS (
            SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM documents
        ), b AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
            FROM benchmark
        ), bw AS (
            SELECT DISTINCT item_id, span, array_to_string(ws[k:k + span - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(ws) - span + 2)) AS k
                  FROM (SELECT *, least(10, len(ws)) AS span FROM b WHERE len(ws) > 0))
        ), dw AS (
            SELECT rid, span, k, array_to_string(ws[k:k + span - 1], ' ') AS win
            FROM (SELECT d.*, s.span, unnest(range(1, len(ws) - s.span + 2)) AS k
                  FROM d, (SELECT DISTINCT span FROM bw) s WHERE len(ws) >= s.span)
        ), h AS MATERIALIZED (SELECT rid, k, span, item_id FROM dw JOIN bw USING (span, win)),
        c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(k, k + span)) AS p FROM h) GROUP BY 1),
        i AS (SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS list
              FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY 1)
        SELECT d.doc_id, len(d.ws) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
               sha256(coalesce(i.list, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN c USING (rid) LEFT JOIN i USING (rid)
    """,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
