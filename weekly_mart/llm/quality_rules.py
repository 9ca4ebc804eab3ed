"""Operator 5: quality rules as weak supervision.

Each rule votes good, votes bad or abstains. Expectation-maximisation over the
vote patterns of all documents estimates how often each rule is right on good
and on bad texts, and the posterior probability of good quality decides, in
place of a filter that every rule has to pass.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import materialise
from weekly_mart.llm.textscan import Chunk, chunks, mix, windows

SYMBOLS = b"#*$%&|<>"
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_ended_lines", "n_distinct_words", "n_letter_words", "n_upper", "n_letters",
]

_flag = np.zeros((5, 256), np.uint8)
_flag[0, list(SYMBOLS)] = 1
_flag[1, 0x41:0x5B] = 1  # upper case
_flag[2, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC3, 0x100)]] = 1  # first bytes of letters
_flag[3, [0x2E, 0x21, 0x3F, 0x22, 0x3A]] = 1  # line ends . ! ? " :
_flag[4, [*range(0x80), *range(0xC0, 0x100)]] = 1  # first bytes of code points


def _count_chunk(c: Chunk) -> dict[str, np.ndarray]:
    n_texts = c.last - c.first
    starts, ends = c.words()
    text_of = c.texts_of(starts)
    first = c.first_of(starts)
    words = c.hashes(starts, ends)
    in_word = np.zeros(len(c.data) + 1, np.int8)
    np.add.at(in_word, starts, 1)
    np.add.at(in_word, ends, -1)
    in_word = np.cumsum(in_word[:-1], dtype=np.int8).astype(bool)

    def distinct(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """How many times each hash occurs in its text, for each entry."""
        _, where, n = np.unique(mix(hashes + owner.astype(np.uint64)), return_inverse=True, return_counts=True)
        return n[where]

    def per_text(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return np.bincount(owner, values, n_texts)

    grams, at = windows(words, text_of, 3)
    again = at[distinct(grams, text_of[at]) > 1]
    covered = np.zeros(len(starts), bool)
    for k in range(3):
        covered[again + k] = True

    lines, line_ends = c.spans(c.data != 0x0A)
    filled = np.searchsorted(starts, line_ends) > np.searchsorted(starts, lines)
    lines, line_ends = lines[filled], line_ends[filled]
    line_of = c.texts_of(lines)
    line_times = distinct(c.hashes(lines, line_ends), line_of)
    last_word = np.searchsorted(starts, line_ends) - 1
    ended = _flag[3][c.data[ends[last_word] - 1]] if len(lines) else np.zeros(0)
    letters = np.zeros(len(c.data) + 1, np.int64)
    np.cumsum(_flag[2][c.data], out=letters[1:])
    n_lines = per_text(np.ones(len(lines)), line_of)
    return {
        "n_words": np.diff(first),
        "word_chars": c.per_text(in_word & (_flag[4][c.data] > 0)),
        "n_symbols": c.per_text(_flag[0][c.data]),
        "n_dup_lines": n_lines - np.round(per_text(1 / line_times, line_of)),
        "n_repeat_words": per_text(covered, text_of),
        "n_lines": n_lines,
        "n_ended_lines": per_text(ended, line_of),
        "n_distinct_words": np.round(per_text(1 / distinct(words, text_of), text_of)),
        "n_letter_words": per_text(letters[ends] > letters[starts], text_of),
        "n_upper": c.per_text(_flag[1][c.data]),
        "n_letters": c.per_text(_flag[2][c.data]),
    }


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, text = batch.columns
        for c in chunks(text):
            found = _count_chunk(c)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(c.first, c.last - c.first)]
                + [pa.array(np.asarray(found[x]).astype(np.int64)) for x in COUNTS],
                names=["_id", *COUNTS],
            )


def text_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, counts) of every whole text; null counts as a text without words."""
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    schema = f"_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
    return narrow.mapInArrow(_count, schema).withColumnRenamed("_id", id_col)


def _share(part: str, whole: str) -> Column:
    return F.col(part) / F.when(F.col(whole) > 0, F.col(whole))


def rules() -> dict[str, tuple[bool, Column]]:
    """Per rule: the vote it casts (True: good) and when it casts it; else it abstains."""
    n = F.col("n_words")
    mean = _share("word_chars", "n_words")
    symbols = _share("n_symbols", "n_words")
    copies = _share("n_dup_lines", "n_lines")
    ended = _share("n_ended_lines", "n_lines")
    fresh = _share("n_distinct_words", "n_words")
    plain = (n >= 50) & (symbols < 0.05) & (_share("n_upper", "n_letters") < 0.3)
    return {
        "sentences": (True, plain & (ended >= 0.8)),
        "prose": (True, plain & (fresh > 0.3) & mean.between(3, 10)),
        "short": (False, n < 50),
        "word_length": (False, (mean < 2.5) | (mean > 14)),
        "symbols": (False, symbols > 0.3),
        "repeats": (False, _share("n_repeat_words", "n_words") > 0.4),
        "copied_lines": (False, (copies > 0.3) & (F.col("n_lines") > 3)),
        "few_letters": (False, _share("n_letter_words", "n_words") < 0.7),
        "no_sentences": (False, ended < 0.1),
        "capitals": (False, _share("n_upper", "n_letters") > 0.5),
        "stale": (False, (fresh < 0.1) & (n >= 50)),
    }


def votes() -> dict[str, Column]:
    """1 good, 0 bad, null abstains."""
    return {
        name: F.when(cast, F.lit(int(good))).cast("byte") for name, (good, cast) in rules().items()
    }


#: Belief before any vote is seen: how often a vote is right, and the share of good texts.
RIGHT, GOOD = 0.95, 0.9


def fit(patterns: np.ndarray, n: np.ndarray, *, rounds: int = 100) -> tuple[float, np.ndarray]:
    """Expectation-maximisation over vote patterns and their counts.

    Votes are 0 bad, 1 good, -1 abstains; a rule casts one kind of vote only.
    Returns the share of good texts and the accuracy of each rule: how often its
    vote names the true class. The beliefs above weigh as much as the data, so
    the classes can't swap and a rule whose votes no other rule meets keeps the
    accuracy it is believed to have.
    """
    cast = (patterns >= 0).astype(float)
    good = (patterns == 1).any(0)
    share, right = GOOD, np.full(patterns.shape[1], RIGHT)
    for _ in range(rounds):
        posterior = 1 / (1 + np.exp(-(math.log(share / (1 - share)) + cast @ _gains(share, right, good))))
        share = float((n @ posterior + n.sum() * GOOD + GOOD) / (2 * n.sum() + 1))
        votes_of = n @ cast
        agree = np.where(good, (n * posterior) @ cast, (n * (1 - posterior)) @ cast)
        right = (agree + votes_of * RIGHT + RIGHT) / (2 * votes_of + 1)
    return share, right


def _gains(share: float, right: np.ndarray, good: np.ndarray) -> np.ndarray:
    """What each rule's vote adds to the log odds of good quality; never against its own vote."""
    named = np.where(good, share, 1 - share)
    gain = np.maximum(np.log(right / (1 - right)) - np.log(named / (1 - named)), 0)
    return np.where(good, gain, -gain)


def quality(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """Per row: id, counts, the votes (``vote_*``), ``posterior`` of good quality and ``kept``.

    Texts without words (null, empty) are voted on as short texts only. Rows
    with equal ids or texts are judged one by one; null ids stay null. An empty
    table gives an empty result. Only the id and the text are read.

    The counts are written once; the fit then sees one row per vote pattern
    (2 ** rules at most, whatever the number of documents), and the posterior
    is a plain expression over the votes.
    """
    ballot = votes()
    names = [f"vote_{v}" for v in ballot]
    counted = materialise(
        text_counts(docs, id_col, text_col).withColumns(dict(zip(names, ballot.values(), strict=True))),
        "quality-counts",
    )
    seen = counted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = np.array([[-1 if r[v] is None else r[v] for v in names] for r in seen]).reshape(-1, len(names))
    share, right = fit(patterns, np.array([r["n"] for r in seen], float))
    gains = _gains(share, right, (patterns == 1).any(0))
    terms = [F.lit(math.log(share / (1 - share)))]
    terms += [F.when(F.col(v).isNotNull(), float(g)).otherwise(0.0) for v, g in zip(names, gains, strict=True)]
    score = reduce(lambda a, b: a + b, terms)
    return counted.withColumn("posterior", 1 / (1 + F.exp(-score))).withColumn(
        "kept", F.col("posterior") >= threshold
    )
