"""Operator 8: toxicity by gradient-boosted trees over dense text features.

Features: densities of lexicon words (a written lexicon, and words learned from
labelled texts), insults near second-person pronouns, capitals, punctuation and
obfuscation rates. The margin of the trees is calibrated by isotonic
regression on labelled texts that the trees have not seen.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import forget, materialise, unit

#: Written lexicon by kind; English first, common words of German, French and Spanish after it.
LEXICON = {
    "insult": "idiot idiots moron morons imbecile stupid dumb dumbass fool loser losers clown scum trash garbage "
    "pathetic worthless useless disgusting filthy vermin pig pigs freak creep jerk retard cretin dimwit scumbag "
    "dummkopf trottel abschaum idioten versager idiote connard imbécile débile ordure idiota imbécil estúpido "
    "basura inútil escoria",
    "profanity": "fuck fucking fucked fucker shit shitty bullshit bitch bitches bastard asshole arsehole crap damn "
    "piss cunt dick prick slut whore scheisse scheiße arschloch hure merde putain salope mierda puta joder cabrón",
    "threat": "kill killed murder die hang shoot stab burn destroy hurt beat strangle töten sterben tuer mourir "
    "matar morir",
    "hate": "hate hatred despise loathe subhuman inferior parasite parasites savages animals hasse hass haine "
    "odio detesto",
}
SECOND_PERSON = set("you your yours yourself yourselves u ur ya du dich dir dein ihr euch tu toi te vous vos tú ti usted vosotros".split())
#: Words on each side of an insult that count as near it.
NEAR = 4
#: Digits and signs that stand for letters inside words.
_LEET = str.maketrans("013457@$!", "oieastasi")
_WORD = re.compile(r"[^\W_]+(?:[@$!*'][^\W_]+)*", re.U)
_MASKED = re.compile(r"[^\W\d_]+[@$!*\d]+[^\W_]")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_STRETCHED = re.compile(r"(\w)\1{3}")

NAMES = [
    *[f"d_{k}" for k in LEXICON], "d_learned", "any_lexicon", "distinct_lexicon", "near_you",
    "second_person", "capitals", "shouted", "exclamations", "punctuation", "obfuscated", "stretched", "log_words",
]

#: Bounds of the labelled sample the model is fitted on (expected numbers of rows).
TRAIN_ROWS, CALIBRATION_ROWS, LEXICON_ROWS = 12_000, 6_000, 12_000
#: Learned lexicon: words at most, least number of toxic texts, least log odds ratio.
LEARNED_WORDS, LEARNED_TEXTS, LEARNED_ODDS = 200, 5, 2.5


def words_of(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def features(text: str, learned: frozenset[str]) -> list[float]:
    """Dense features of a whole text; zeros for an empty one."""
    raw = _WORD.findall(text)
    words = [w.lower() for w in raw]
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    count, kinds, at = Counter(), set(), []
    masked = single = 0  # words with signs inside, and letters that stand alone, four in a row or more
    for k, w in enumerate(words):
        plain = w
        if len(w) == 1:
            single += 1
            masked += single == 4
        else:
            single = 0
            if not w.isalpha():
                plain = w.translate(_LEET)
                masked += _MASKED.match(w) is not None
        kind = _KIND.get(plain)
        if kind or plain in learned:
            count[kind or "learned"] += 1
            if kind and plain in learned:
                count["learned"] += 1
            kinds.add(plain)
            at.append(k)
    near = sum(any(v in SECOND_PERSON for v in words[max(0, k - NEAR) : k + NEAR + 1]) for k in at)
    marks = sum(text.count(x) for x in "!?.,;:")
    return [
        *[count[k] / n for k in LEXICON], count["learned"] / n, float(len(at)), float(len(kinds)), near / n,
        sum(w in SECOND_PERSON for w in words) / n,
        len(_CAPITAL.findall(text)) / sum(map(len, raw)),
        sum(len(w) > 2 and w.isupper() for w in raw) / n,
        (text.count("!") + text.count("?")) / n,
        marks / n,
        masked / n,
        len(_STRETCHED.findall(text)) / n,
        float(np.log1p(n)),
    ]


_KIND = {w: kind for kind, listed in LEXICON.items() for w in listed.split()}


def text_features(docs: DataFrame, learned: list[str], *, text_col: str, keep: list[str]) -> DataFrame:
    """The kept columns and one double per feature, for whole texts; null counts as empty."""
    known = frozenset(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t or "", known) for t in batch.column(len(keep)).to_pylist()]
            values = np.array(rows, float).reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], *[pa.array(values[:, k]) for k in range(len(NAMES))]],
                names=[*keep, *NAMES],
            )

    narrow = docs.select(*keep, F.col(text_col).cast("string").alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return narrow.mapInArrow(run, schema + "".join(f", {n} double" for n in NAMES))


def _word_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per class and word: how many texts have it, summed over the batch."""
    for batch in batches:
        found: Counter = Counter()
        for text, toxic in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found.update((w, toxic) for w in set(words_of(text or "")))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([w for w, _ in found], pa.string()),
                pa.array([t for _, t in found], pa.int32()),
                pa.array(list(found.values()), pa.int64()),
            ],
            names=["word", "toxic", "n"],
        )


def learn_lexicon(labelled: DataFrame, *, text_col: str) -> list[str]:
    """Words that stand in many more toxic texts than others, by log odds ratio.

    ``labelled`` is a bounded sample with a column ``_toxic``; at most
    ``LEARNED_WORDS`` rows reach the driver.
    """
    totals = {r["_toxic"]: r["n"] for r in labelled.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = (
        labelled.select(F.col(text_col).cast("string"), F.col("_toxic").cast("int"))
        .mapInArrow(_word_texts, "word string, toxic int, n long")
        .groupBy("word")
        .agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("yes"),
            F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("no"),
        )
    )
    odds = F.log((F.col("yes") + 0.5) / (totals.get(1, 0) + 1)) - F.log((F.col("no") + 0.5) / (totals.get(0, 0) + 1))
    best = (
        counts.where((F.col("yes") >= LEARNED_TEXTS) & (odds >= LEARNED_ODDS))
        .orderBy((odds * F.sqrt("yes")).desc(), "word")
        .limit(LEARNED_WORDS)
    )
    return [r["word"] for r in best.collect()]


@dataclass
class ToxicityModel:
    trees: object
    calibration: object
    learned: list[str] = field(default_factory=list)
    fallback: float = 0.0  # share of toxic texts, where only one class was seen


def fit_toxicity(
    labelled: DataFrame, *, text_col: str = "text", label_col: str = "toxic", labels: DataFrame | None = None,
    id_col: str = "doc_id", trees: int = 20, depth: int = 3, seed: int = 8,
) -> ToxicityModel:
    """Learns from labelled rows (label 0 or 1; other labels and nulls are left out).

    The labels are a column of ``labelled``, or of the table ``labels``, which is
    met on ``id_col``; in that case only ids and hashes of texts are joined.

    Bounded samples are drawn from the distinct labelled texts by their hash, so
    that a text falls into one part and counts once for each label it has,
    however many copies there are: a fifth calibrates and the rest trains the
    trees; the learned lexicon comes from the training part. Only texts of the
    samples are shuffled.
    """
    text = F.col(text_col).cast("string")
    part = unit(F.coalesce(text, F.lit("")), seed=seed)
    usable, label = F.col(label_col).isin(0, 1), F.col(label_col).cast("int").alias("_toxic")
    if labels is None:
        labelled = labelled.where(usable)
        marked = labelled.select(part.alias("_part"), label)
    else:
        given = labels.where(usable).select(F.col(id_col).alias("_named"), label)
        marked = labelled.select(F.col(id_col).alias("_id"), part.alias("_part")).join(given, F.col("_id") == F.col("_named"))
    distinct = materialise(marked.select("_part", "_toxic").distinct(), "toxic-parts")
    n, toxic = distinct.agg(F.count(F.lit(1)), F.coalesce(F.avg("_toxic"), F.lit(0.0))).first()
    train_share = min(1.0, max(TRAIN_ROWS, LEXICON_ROWS) / max(1, 0.8 * n))
    calibration_share = min(1.0, CALIBRATION_ROWS / max(1, 0.2 * n))
    if toxic in (0.0, 1.0):
        return ToxicityModel(None, None, [], float(toxic))
    in_train = F.col("_part") < 0.8 * train_share
    drawn = in_train | ((F.col("_part") >= 0.8) & (F.col("_part") < 0.8 + 0.2 * calibration_share))
    texts = labelled.select(text.alias("_text"), part.alias("_part")).where(drawn)
    sample = materialise(
        distinct.where(drawn).join(texts.groupBy("_part").agg(F.first("_text").alias("_text")), "_part"), "toxic-sample"
    )
    learned = learn_lexicon(sample.where(in_train), text_col="_text")
    seen = materialise(text_features(sample, learned, text_col="_text", keep=["_toxic", "_part"]), "toxic-train")
    forget(distinct, sample)
    vectors = VectorAssembler(inputCols=NAMES, outputCol="_features").transform(seen)
    model = GBTClassifier(
        featuresCol="_features", labelCol="_toxic", predictionCol="_class", maxIter=trees, maxDepth=depth, stepSize=0.2, seed=seed,
        cacheNodeIds=False, checkpointInterval=-1,
    ).fit(vectors.where("_part < 0.8").repartition(2))
    calibration = IsotonicRegression(featuresCol="_margin", labelCol="_label", predictionCol="_step").fit(
        _margin(model, vectors.where("_part >= 0.8")).select("_margin", F.col("_toxic").cast("double").alias("_label"))
    )
    return ToxicityModel(model, calibration, learned)


def _margin(model, vectors: DataFrame) -> DataFrame:
    return model.transform(vectors).withColumn("_margin", vector_to_array("rawPrediction")[1])


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id and ``score`` (0 to 1, calibrated probability of toxicity).

    Null and empty texts have zero features and get the score of such texts.
    Rows are independent of each other; equal texts get equal scores. With no
    or one class of labels the score is the share of toxic labels.
    """
    if model.trees is None:
        return docs.select(F.col(id_col), F.lit(model.fallback).alias("score"))
    found = text_features(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body")), model.learned,
        text_col="_body", keep=["_id"],
    )
    vectors = VectorAssembler(inputCols=NAMES, outputCol="_features").transform(found)
    steps = model.calibration.transform(_margin(model.trees, vectors))
    # a thousandth of the margin is mixed in, so that texts on one step keep their order
    fine = 0.999 * F.col("_step") + 0.001 / (1 + F.exp(-F.col("_margin")))
    score: Column = F.least(F.greatest(fine, F.lit(0.0)), F.lit(1.0))
    return steps.select(F.col("_id").alias(id_col), score.alias("score"))
