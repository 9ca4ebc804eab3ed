"""From raw documents to packed training bins: five stages, each over all its predecessor kept.

1. ``language_id``: documents whose language can't be determined go.
2. ``exact_dedup``: one row of each group of equal texts stays.
3. ``ngram_jaccard``: one document of each component of near duplicates (five-word
   shingles, Jaccard similarity 0.8 or more) stays.
4. ``mixing``: sources are repeated to temperature weights, at most twice, none left out.
5. ``best_fit_packing``: the pieces of all documents with their bins.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weekly_mart.llm.best_fit_packing import pack
from weekly_mart.llm.common import scratch_root, table
from weekly_mart.llm.exact_dedup import drop_copies
from weekly_mart.llm.language_id import keep_identified, learn_languages
from weekly_mart.llm.ngram_join import keep_one_of_each
from weekly_mart.llm.temperature_mix import repeat_to_weights

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs, learn_languages(docs))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one_of_each(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return repeat_to_weights(docs, max_repeats=2.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs, capacity=2048)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("mixing", mixing),
    ("best_fit_packing", best_fit_packing),
]

#: The first stage scores texts with learned context trees, which SQL can't express.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to shared storage and read again."""
    docs = table(spark, sf_dir, "documents")
    home = f"{scratch_root(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (name, stage) in enumerate(STAGES):
        path = f"{home}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
