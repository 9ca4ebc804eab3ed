"""Operator 13: benchmark decontamination by winnowing. DataFrame functions only.

A benchmark window is a run of ``SPAN`` words of an item, or the whole item
where it is shorter. Of every window-long run of words the least hash of a
half-window gram is its fingerprint, so a document that holds a window anywhere
has the window's fingerprint among its own.

1. The fingerprints of the documents meet those of the benchmark. Only places
   that meet one go on, about one word in three is looked at.
2. A hit is extended: the runs of words around it are compared with the windows
   themselves, word by word. What is reported is exact; a hash can't add or lose
   a hit.
3. Windows that the same items have form one class, so a passage that many
   items share costs one row a document and class before the items are listed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weekly_mart.llm.common import let, materialise

#: Words of a window.
SPAN = 10
#: Fingerprints of the benchmark that are sent to all executors (24 bytes each); beyond it they are joined by shuffle.
BROADCAST_ROWS = 1_000_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII characters that stand outside words once A-Z are lower-cased.
_OUTSIDE = "".join(chr(c) for c in range(0x80) if not (chr(c).isdigit() or chr(c).isalpha()))


def words(text: Column) -> Column:
    """Words of a text: runs of digits, letters (A-Z in lower case) and characters beyond ASCII."""
    spaced = F.translate(F.coalesce(text.cast("string"), F.lit("")), _UPPER + _OUTSIDE, _LOWER + " " * len(_OUTSIDE))
    return F.array_remove(F.split(spaced, " "), "")


def _sliding(values: Column, width: int, join, use) -> Column:
    """``use`` of the array whose entry i joins entries i to i + width - 1, in as many steps as ``width`` has bits.

    ``join`` gets two entries and how many values each of them covers. Entries near the end lack values.
    """

    def widen(have: int):
        def step(c: Column) -> Column:
            if have == width:
                return use(c)
            shift = min(have, width - have)
            return let(F.transform(c, lambda x, i: join(x, F.get(c, i + shift), have)), widen(have + shift))

        return step

    return let(values, widen(1))


def _but_last(values: Column, n: int) -> Column:
    return F.slice(values, F.lit(1), F.greatest(F.size(values) - n, F.lit(0))) if n else values


def fingerprints(text_words: Column, span: int) -> Column:
    """Winnowed grams of a word array: structs of span, hash and place.

    Grams of k words and windows of w grams, k + w - 1 = span: any run of
    ``span`` words holds a whole window, whose least gram is chosen in every
    text. It is named once, at the first window that has it, and stands for the
    w windows from there at most: where the gram leaves the window and an equal
    one follows, it is named again.
    """
    k = (span + 1) // 2
    width = span - k + 1

    def mixed(x: Column, y: Column, have: int) -> Column:
        return x.bitwiseXOR(F.shiftleft(y, 11 * have % 53))

    def chosen(grams: Column) -> Column:
        def named(least: Column) -> Column:
            fresh = lambda x, i: ~x.eqNullSafe(F.get(least, i - 1)) | (F.get(grams, i - 1) == x)
            place = lambda x, i: F.struct(F.lit(span).alias("span"), x.alias("hash"), i.alias("at"))
            return F.filter(
                F.transform(least, lambda x, i: F.when(fresh(x, i), place(x, i))), lambda p: p.isNotNull()
            )

        return _sliding(grams, width, lambda x, y, _: F.least(x, y), lambda m: let(_but_last(m, width - 1), named))

    hashed = F.transform(text_words, lambda w: F.xxhash64(F.lit(span), w))
    return _sliding(hashed, k, mixed, lambda g: let(_but_last(g, k - 1), chosen))


def _starts(text_words: Column, span: Column, at: Column) -> Column:
    """Starts of the runs of ``span`` words that the fingerprint at a place can stand for."""
    width = span - F.floor((span + 1) / 2).cast("int") + 1
    return F.sequence(at, F.least(at + width - 1, F.size(text_words) - span))


def _run(text_words: Column, start: Column, span: Column) -> Column:
    return F.array_join(F.slice(text_words, start + 1, span), " ")


def benchmark_windows(benchmark: DataFrame, item_col: str, text_col: str, span: int) -> DataFrame:
    """(item, span, start, window) of all items; a shorter item is one window."""
    spread = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("words"))
    sized = spread.withColumn("span", F.least(F.size("words"), F.lit(span))).where("span > 0")
    starts = F.sequence(F.lit(0), F.size("words") - F.col("span"))
    return sized.select("item", "span", "words", F.explode_outer(starts).alias("start")).select(
        "item", "span", "start", _run(F.col("words"), F.col("start"), F.col("span")).alias("window")
    )


def _met(docs: DataFrame, prints: DataFrame, small: bool) -> DataFrame:
    """(k1, k2, words, span, at): places of documents whose fingerprint the benchmark has."""
    places = docs.select("k1", "k2", "words", F.explode_outer("prints").alias("p"))
    if small:
        # the words of a document are only looked at again where a place meets the benchmark
        held = F.broadcast(prints)
        return places.join(held, (F.col("p.span") == held.span) & (F.col("p.hash") == held.hash)).select(
            "k1", "k2", "words", "p.span", "p.at"
        )
    narrow = places.select("k1", "k2", "p.span", "p.hash", "p.at").where("hash IS NOT NULL")
    found = materialise(
        narrow.join(prints, ["span", "hash"], "left_semi").select("k1", "k2", "span", "at").distinct(), "leak-places"
    )
    texts = docs.select("k1", "k2", "words")
    wanted = found.select(F.col("k1").alias("_1"), F.col("k2").alias("_2"), "span", "at")
    return texts.join(wanted, (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2"))).select(
        "k1", "k2", "words", "span", "at"
    )


def shared_passages(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", span: int = SPAN, broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``spans`` and ``items``.

    ``spans`` are the runs of words (start, end) that windows of the benchmark
    cover, joined where they touch or overlap; ``items`` the ids of the items
    with a window in the text, as sorted strings. Null and empty texts have no
    words and no windows, on both sides. Items of the same id are one item; an
    item without an id covers words but is not listed. Repeated rows, and equal
    texts under any id, get equal results. An empty benchmark leaves every row
    clean; empty ``docs`` give an empty result. Only the named columns are read.

    Scale: fingerprints of up to ``broadcast_rows`` are sent to the executors,
    counted before; then one pass over the texts finds all places. Beyond that
    they are joined by shuffle, places first and texts of met places after, with
    the same result. Copies share one key, and places are made distinct before
    they are brought together, so a passage in a third of all documents is split.
    """
    windows = materialise(
        benchmark_windows(benchmark, item_col, item_text_col, span), "leak-windows"
    )
    lengths = sorted(r[0] for r in windows.select("span").distinct().collect()) or [span]
    prints = materialise(
        windows.select(
            F.explode_outer(
                F.concat(*[
                    F.when(F.col("span") == n, fingerprints(F.split("window", " "), n)).otherwise(
                        F.array().cast("array<struct<span:int,hash:bigint,at:int>>")
                    )
                    for n in lengths
                ])
            ).alias("p")
        ).select("p.span", "p.hash").distinct(),
        "leak-prints",
    )
    # windows by the set of items that have them: the set as two combined hashes
    pairs = windows.select("span", "window", "item").distinct()
    keyed = materialise(
        pairs.groupBy("span", "window").agg(
            F.bit_xor(F.xxhash64(F.lit(1), "item")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(2), "item")).alias("s2")
        ),
        "leak-classes",
    )
    first = keyed.groupBy("s1", "s2").agg(F.min(F.struct("span", "window")).alias("w"))
    sets = materialise(
        first.select("s1", "s2", "w.span", "w.window").join(pairs, ["span", "window"]).where("item IS NOT NULL")
        .select(F.col("s1").alias("_s1"), F.col("s2").alias("_s2"), "item"),
        "leak-sets",
    )
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(F.lit(1), text).alias("k1"), F.xxhash64(F.lit(2), text).alias("k2"),
        words(text).alias("words"),
    )
    scanned = rows.select(
        "k1", "k2", "words", F.concat(*[fingerprints(F.col("words"), n) for n in lengths]).alias("prints")
    )
    small = prints.limit(broadcast_rows + 1).count() <= broadcast_rows
    tried = (
        _met(scanned, prints, small)
        .select("k1", "k2", "words", "span", F.explode_outer(_starts(F.col("words"), F.col("span"), F.col("at"))).alias("start"))
        .select("k1", "k2", "span", "start", _run(F.col("words"), F.col("start"), F.col("span")).alias("window"))
    )
    hits = materialise(
        tried.join(keyed, ["span", "window"]).select(
            "k1", "k2", "start", (F.col("start") + F.col("span")).alias("end"), "s1", "s2"
        ).distinct(),
        "leak-hits",
    )
    by_text = Window.partitionBy("k1", "k2").orderBy("start", "end")
    reach = F.max("end").over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    spans = (
        hits.select("k1", "k2", "start", "end").distinct()
        .withColumn("fresh", (reach.isNull() | (F.col("start") > reach)).cast("int"))
        .withColumn("island", F.sum("fresh").over(by_text.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("k1", "k2", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    )
    items = (
        hits.select("k1", "k2", "s1", "s2").distinct()
        .join(sets, (F.col("s1") == F.col("_s1")) & (F.col("s2") == F.col("_s2")))
        .groupBy("k1", "k2").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    answer = materialise(
        spans.join(items, ["k1", "k2"], "left").select(
            F.col("k1").alias("_1"), F.col("k2").alias("_2"), "spans", "items"
        ),
        "leak-answers",
    )
    counted = rows.select("id", "k1", "k2", F.size("words").cast("long").alias("n_words"))
    return counted.join(answer, (F.col("k1") == F.col("_1")) & (F.col("k2") == F.col("_2")), "left").select(
        F.col("id").alias(id_col), "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
