"""Operator 9: language identification by prediction by partial matching.

Every language has a variable-order byte context tree. A symbol that its
longest known context has not seen escapes to the next shorter one; the escape
probability is the number of distinct symbols over that number plus the count
(method C). A text goes to the language whose frozen tree codes it in the
fewest bits.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import bound_batches, unit
from weekly_mart.llm.textscan import chunks

#: Bytes of context in the longest branch.
ORDER = 3
#: Expected number of distinct labelled texts a language is learned from (all, where it has fewer).
SAMPLE_DOCS = 400
UNDETERMINED = "und"
#: Tasks that count the byte strings of the sample.
COUNT_TASKS = 4
#: Bytes of the sample that are counted at a time; fewer would make more partial counts.
COUNTED_BYTES = 1 << 20
#: Contexts whose probabilities are worked out at a time, and bytes of text that are coded at a time.
CONTEXTS, CODED_BYTES = 1024, 1 << 17

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass
class LanguageModel:
    """Counts of byte strings of 1 to ORDER + 1 bytes, by language."""

    langs: list[str]
    lang: np.ndarray  # index into langs
    size: np.ndarray  # bytes of the string
    gram: np.ndarray  # its bytes as a big-endian number
    count: np.ndarray

    def narrow(self) -> tuple:
        """The fields in as few bytes as hold them: a worker process keeps what is sent to it."""
        fields = [x.astype(np.min_scalar_type(int(x.max(initial=0)))) for x in (self.lang, self.size, self.gram, self.count)]
        return self.langs, *fields

    @staticmethod
    def widened(langs: list[str], *fields: np.ndarray) -> LanguageModel:
        return LanguageModel(langs, *[x.astype(np.int64) for x in fields])

    def tables(self) -> Tables:
        """The trees of all languages as one automaton over byte classes."""
        n_langs = len(self.langs)
        seen = np.unique(self.gram[self.size == 1])
        code = np.zeros(256, np.int64)  # 0: a byte that no training text has, or no byte at all
        code[seen] = np.arange(1, len(seen) + 1)
        width = len(seen) + 1
        starts = [0]
        nodes, parents = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)]  # per order: the sorted contexts, as numbers to base ``width``
        for order in range(1, ORDER + 1):
            own = self._coded(order + 1, code, width)
            contexts = np.unique(own // width)
            shorter = contexts % width ** (order - 1)
            parent = np.searchsorted(nodes[-1], shorter)
            known = (parent < len(nodes[-1])) & (nodes[-1][np.minimum(parent, len(nodes[-1]) - 1)] == shorter)
            # a context's end is itself a context, but where it stands only at the end of texts
            starts.append(starts[-1] + len(nodes[-1]))
            nodes.append(contexts[known])
            parents.append(parent[known])
        # child[row * width + c]: the row of the context that c precedes, or the row itself
        total = starts[-1] + len(nodes[-1])
        child = np.repeat(np.arange(total, dtype=np.int32), width)
        for order in range(1, ORDER + 1):
            at = nodes[order]
            parent = np.searchsorted(nodes[order - 1], at % width ** (order - 1)) + starts[order - 1]
            child[parent * width + at // width ** (order - 1)] = np.arange(len(at)) + starts[order]
        # order -1 is one of 256 bytes, equally likely; some contexts at a time, so that no order is held in doubles twice
        bits = np.empty((total, width, n_langs), np.float32)
        shorter = np.full((1, width, n_langs), 1 / 256)
        for order in range(ORDER + 1):
            rows = []
            for low in range(0, len(nodes[order]), CONTEXTS):
                some = slice(low, low + CONTEXTS)
                found = _blend(shorter[parents[order][some]], self._counts(order + 1, code, width, nodes[order][some]))
                bits[starts[order] + low : starts[order] + low + len(found)] = -np.log2(found)
                if order < ORDER:
                    rows.append(found)
            shorter = np.concatenate(rows) if rows else shorter
        return Tables(code.astype(np.int32), width, child, bits.reshape(-1, n_langs), starts)

    def _coded(self, size: int, code: np.ndarray, width: int) -> np.ndarray:
        gram = self.gram[self.size == size]
        out = np.zeros(len(gram), np.int64)
        for k in reversed(range(size)):
            out = out * width + code[(gram >> (8 * k)) & 255]
        return out

    def _counts(self, size: int, code: np.ndarray, width: int, contexts: np.ndarray) -> np.ndarray:
        own = self._coded(size, code, width)
        at = np.searchsorted(contexts, own // width)
        ok = (at < len(contexts)) & (contexts[np.minimum(at, len(contexts) - 1)] == own // width)
        counts = np.zeros((len(contexts), width, len(self.langs)))
        mine = self.size == size
        np.add.at(counts, (at[ok], own[ok] % width, self.lang[mine][ok]), self.count[mine][ok])
        return counts


def _blend(shorter: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Probabilities after one more byte of context."""
    n, kinds = counts.sum(1, keepdims=True), (counts > 0).sum(1, keepdims=True)
    scale = np.where(n > 0, n + kinds, 1)
    return np.where(counts > 0, counts / scale, np.where(n > 0, kinds / scale, 1) * shorter)


@dataclass
class Tables:
    code: np.ndarray
    width: int
    child: np.ndarray
    bits: np.ndarray  # (row * width + symbol, language)
    starts: list[int]

    def code_lengths(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Bits that each language's tree needs for each text."""
        symbols = self.code[data]
        row, before = np.zeros(len(symbols), np.int32), symbols
        first = bounds[:-1][bounds[:-1] < len(symbols)]
        deeper = np.ones(len(symbols), bool)
        for _ in range(ORDER):
            before = np.concatenate(([0], before[:-1])).astype(np.int32)
            before[first] = 0
            longer = np.where(deeper, self.child[row * self.width + before], row)
            deeper = longer != row
            row = longer
        cost = self.bits[row.astype(np.int64) * self.width + symbols]
        sums = np.zeros((len(symbols) + 1, cost.shape[1]))
        np.cumsum(cost, axis=0, dtype=np.float64, out=sums[1:])
        return sums[bounds[1:]] - sums[bounds[:-1]]


def _gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, text = batch.columns
        langs = langs.to_pylist()
        for c in chunks(text, COUNTED_BYTES):
            # a string of four bytes at most is a number of 32 bits
            data, text_of = c.data.astype(np.uint32), np.repeat(np.arange(c.last - c.first, dtype=np.int32), np.diff(c.bounds))
            for lang in set(langs[c.first : c.last]):
                mine = np.array([x == lang for x in langs[c.first : c.last]])
                gram = np.zeros(len(data), np.uint32)
                for size in range(1, ORDER + 2):
                    n = len(data) - size + 1
                    if n <= 0:
                        break
                    gram = (gram[:n] << np.uint32(8)) | data[size - 1 :]
                    whole = (text_of[:n] == text_of[size - 1 :]) & mine[text_of[:n]]
                    found, count = np.unique(gram[whole], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(found), pa.string()),
                            pa.array(np.full(len(found), size, np.int32)),
                            pa.array(found.astype(np.int64)),
                            pa.array(count.astype(np.int64)),
                        ],
                        names=["lang", "size", "gram", "n"],
                    )


def learn_languages(
    docs: DataFrame,
    *,
    text_col: str = "text",
    lang_col: str = "lang",
    usable: Column | None = None,
    sample_docs: int = SAMPLE_DOCS,
    seed: int = 9,
) -> LanguageModel:
    """Trees learned from about ``sample_docs`` distinct whole texts per language.

    ``usable`` marks the rows that may be learned from. Rows without language or
    text are left out. Texts are drawn by their hash, each once however many
    copies it has, and all of a language that has no more than the bound; so a
    language of few texts with many copies is learned too, and repeated runs
    learn the same. What reaches the driver is one row per byte string of the
    sample: bounded by the sample.
    """
    rows = docs.where(usable) if usable is not None else docs
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("_text")).where(
        "lang IS NOT NULL AND length(_text) > 0"
    ).withColumn("_hash", F.xxhash64("_text"))
    distinct = rows.select("lang", "_hash").distinct()
    sizes = {r["lang"]: r["n"] for r in distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        empty = np.zeros(0, np.int64)
        return LanguageModel([], empty, empty, empty, empty)
    chance = F.element_at(
        F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample_docs / n))]), F.col("lang")
    )
    # copies of a drawn text are combined before the shuffle
    drawn = rows.where(unit("_hash", seed=seed) < chance).groupBy("lang", "_hash").agg(F.first("_text").alias("_text")).drop("_hash")
    # a bounded sample: few tasks count it, so that few partial counts are made
    counts = (
        drawn.coalesce(COUNT_TASKS).mapInArrow(_gram_counts, "lang string, size int, gram long, n long")
        .groupBy("lang", "size", "gram")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = sorted(set(counts["lang"].to_pylist()))
    at = {x: k for k, x in enumerate(langs)}
    return LanguageModel(
        langs,
        np.array([at[x] for x in counts["lang"].to_pylist()], np.int64),
        *[counts[c].to_numpy().astype(np.int64) for c in ("size", "gram", "n")],
    )


#: Compiled trees of the model a worker process has used last.
_compiled: dict[str, Tables | None] = {}


def _predictor(model: LanguageModel, spark):
    """A function for tasks: names and scores of the texts of a string column."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model.narrow())
    name, model_langs = uuid.uuid4().hex, model.langs

    def load():
        if name not in _compiled:  # once for each worker process, which keeps the last model only
            _compiled.clear()
            _compiled[name] = LanguageModel.widened(*shared.value).tables() if model_langs else None
        tables, langs = _compiled[name], np.array(model_langs, object)

        def predict(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
            names, score = np.full(len(text), UNDETERMINED, object), np.zeros(len(text))
            for c in chunks(text, CODED_BYTES):
                has_letter = c.per_text(_ASCII_LETTER[c.data]) > 0
                for k in np.flatnonzero(~has_letter & (c.per_text(c.data >= 0xC2) > 0)):
                    own = bytes(c.data[c.bounds[k] : c.bounds[k + 1]]).decode("utf-8", "replace")
                    has_letter[k] = any(x.isalpha() for x in own)
                if tables is None:
                    continue
                bits = tables.code_lengths(c.data, c.bounds)
                gap = np.minimum(bits - bits.min(1, keepdims=True), 1000)
                names[c.first : c.last][has_letter] = langs[bits.argmin(1)[has_letter]]
                score[c.first : c.last] = np.where(has_letter, 1 / np.exp2(-gap).sum(1), 0.0)
            return names, score

        return predict

    return load


def identify_language(
    docs: DataFrame, model: LanguageModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``lang_pred`` and ``score`` (posterior of the winner, 0 to 1).

    ``und`` with score 0 where the text is null or has no letter, or the model
    has no language. Ties go to the language that sorts first. Whole texts are
    coded, in one pass without a shuffle; rows are independent of each other.
    """
    load = _predictor(model, docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()
        for batch in batches:
            names, score = predict(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(score)], names=["_id", "lang_pred", "score"]
            )

    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    out = narrow.mapInArrow(run, f"_id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("_id", id_col)


def keep_identified(
    docs: DataFrame, model: LanguageModel, *, text_col: str = "text", least_score: float = 0.5
) -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least this score, all columns unchanged."""
    load = _predictor(model, docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = load()
        for batch in batches:
            names, score = predict(batch.column(at))
            yield batch.filter(pa.array((names != UNDETERMINED) & (score >= least_score)))

    return docs.mapInArrow(run, docs.schema)
