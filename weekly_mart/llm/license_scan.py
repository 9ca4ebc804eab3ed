"""Operator 2: license scan by ordered signature rules. DataFrame functions only.

Words are lower-cased (A-Z) runs of digits, letters and non-ASCII characters.
A rule is tried where one of its keywords occurs; of overlapping detections, one that
lies within another of the same or a higher priority is suppressed.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import let, running
from weekly_mart.llm.license_rules import GATES, Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A word before lower-casing.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Phrases that are counted at all their places.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
CONFIDENCE = {1: 0.9, 2: 0.7, 3: 0.5}


def normalised(text: Column) -> Column:
    """Words with a space on both sides of each: ' free  software '."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, SEPARATORS, "  ")), F.lit(" "))


def _spaces(part: Column) -> Column:
    return F.length(part) - F.length(F.replace(part, F.lit(" "), F.lit("")))


def phrase_places(norm: Column, phrases: dict[str, str]) -> Column:
    """Label and word index of every place of each phrase, phrase after phrase, ascending."""
    table = F.array(*[
        F.struct(
            F.lit(f" {p.replace(' ', '  ')} ".replace(" ", "[ ]")).alias("key"), F.lit(len(p.split())).alias("words"),
            F.lit(label).alias("label"),
        )
        for p, label in phrases.items()
    ])

    def places(p: Column) -> Column:
        # words up to the end of each place: those of the part before it, and its own
        counts = F.transform(F.split(norm, p.key, -1), lambda part: F.floor(_spaces(part) / 2) + p.words)
        ends = running(counts, F.lit(0).cast("long"), lambda x, y: x + y)
        placed = F.transform(ends, lambda n: F.struct((n - p.words).alias("word"), p.label.alias("label")))
        return F.slice(placed, F.lit(1), F.size(placed) - 1)

    return F.flatten(F.transform(table, places))


def _rule_table(table: list[Rule]) -> Column:
    """The rules as one constant array; patterns fit the normalised text."""
    rows = [
        {
            "rule": k, "priority": r.priority, "label": r.label, "keywords": r.keywords,
            "pattern": "(?<= )(?:" + r.pattern.replace(" ?", "(?: )?").replace(" ", "  ") + ")(?= )",
        }
        for k, r in enumerate(table)
    ]
    kind = "array<struct<rule:int,priority:int,label:string,keywords:array<string>,pattern:string>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def detections(norm: Column, table: list[Rule]) -> Column:
    """All detections of a text, suppressed ones left out, by position: structs of start, negative end (character
    offsets of the normalised text), priority, rule, label, first and last word.

    Offsets are running sums over the pieces that the matches cut the text into.
    """
    keywords = F.filter(
        F.array(*[F.lit(k) for k in sorted({k for r in table for k in r.keywords})]), lambda k: F.contains(norm, k)
    )

    def matches(r: Column) -> Column:
        def places(hits: Column) -> Column:
            sizes = F.zip_with(
                F.slice(F.split(norm, r.pattern, -1), F.lit(1), F.size(hits)), hits,
                lambda p, h: F.struct(
                    (F.length(p) + F.length(h)).alias("chars"), (_spaces(p) + _spaces(h)).alias("spaces")
                ),
            )
            add = lambda x, y: F.struct((x.chars + y.chars).alias("chars"), (x.spaces + y.spaces).alias("spaces"))
            return F.zip_with(
                hits, running(sizes, F.struct(F.lit(0).alias("chars"), F.lit(0).alias("spaces")), add),
                lambda h, t: F.struct(
                    (t.chars - F.length(h)).alias("start"), (-t.chars).alias("neg_end"), r.priority.alias("priority"),
                    r.rule.alias("rule"), r.label.alias("label"),
                    F.floor((t.spaces - _spaces(h)) / 2).alias("first_word"), F.floor(t.spaces / 2).alias("last_word"),
                ),
            )

        return let(F.regexp_extract_all(norm, r.pattern, F.lit(0)), places)

    def scan(present: Column) -> Column:
        tried = F.filter(_rule_table(table), lambda r: F.arrays_overlap(present, r.keywords))
        return let(F.array_sort(F.flatten(F.transform(tried, matches))), _suppressed)

    return let(keywords, scan)


def _suppressed(ordered: Column) -> Column:
    """Of detections by start and falling end, those that no earlier one of the same or a higher priority
    reaches beyond, by the furthest end so far of each priority and the ones above it."""
    levels = sorted(CONFIDENCE)
    reach = F.transform(
        ordered, lambda d: F.struct(*[F.when(d.priority <= k, -d.neg_end).otherwise(F.lit(-1)).alias(f"p{k}") for k in levels])
    )
    further = lambda x, y: F.struct(*[F.greatest(x[f"p{k}"], y[f"p{k}"]).alias(f"p{k}") for k in levels])

    def shown(furthest: Column) -> Column:
        def beyond(d: Column, i: Column) -> Column:
            before = F.get(furthest, i - 1)
            ends = F.lit(None).cast("int")
            for k in levels:
                ends = F.when(d.priority == k, before[f"p{k}"]).otherwise(ends)
            return F.coalesce(ends, F.lit(-1)) < -d.neg_end

        return F.filter(ordered, beyond)

    none = F.struct(*[F.lit(-1).alias(f"p{k}") for k in levels])
    return let(running(reach, none, further), shown)


def scan_licenses(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", table: list[Rule] | None = None
) -> DataFrame:
    """Per row: the id, ``n_words``, ``places`` (label and word index of every base phrase),
    ``found`` (detections that stay: label, rule, priority, first word) and ``score``.

    Null and empty texts have no words and no detections. Rows are independent
    of each other; equal rows give equal results. Only the id and the text are
    read. One pass without a shuffle, whose time grows with the length of a text
    and, nearly in proportion, with its hits; texts that hold no gate word are only
    counted. ``score`` is one minus the product of the chances that each rule
    that fired is wrong.
    """
    table = table or rules()
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    text, gate = F.col("_text"), F.lit(False)
    for word in GATES:
        gate = gate | F.contains("_lower", F.lit(word.split(" ")[0]))
    gated = docs.select(F.col(id_col), whole.alias("_text"), F.lower(whole).alias("_lower")).select(
        id_col,
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"),
        F.when(gate, normalised(text)).alias("_norm"),
    )
    norm = F.col("_norm")
    no_places = F.array().cast("array<struct<word:bigint,label:string>>")
    places = phrase_places(norm, BASE)
    kind = "array<struct<label:string,rule:int,priority:int,first_word:bigint,last_word:bigint>>"
    found = F.transform(
        detections(norm, table),
        lambda d: F.struct(*[d[c].alias(c) for c in ("label", "rule", "priority", "first_word", "last_word")]),
    )
    scanned = gated.select(
        id_col,
        "n_words",
        F.when(norm.isNotNull(), places).otherwise(no_places).alias("places"),
        F.when(norm.isNotNull(), found).otherwise(F.array().cast(kind)).alias("found"),
    )
    wrong = F.create_map(*[F.lit(x) for k, c in CONFIDENCE.items() for x in (k, 1 - c)])
    fired = F.array_distinct(F.transform("found", lambda d: F.struct(d.rule.alias("rule"), d.priority.alias("priority"))))
    score = 1 - F.aggregate(fired, F.lit(1.0), lambda p, d: p * F.element_at(wrong, d.priority))
    return scanned.withColumn("score", score)
