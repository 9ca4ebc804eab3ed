"""Operator 10: main text of web pages by a host suffix array.

Markup says for most blocks where they stand: in the page's article, in its
furniture (menus, footers, adverts, forms, comments), or neither (open). What
is not furniture is decided by repetition, on every page: the token streams of
a host's distinct pages are concatenated and sorted as a suffix array; word runs
that a share of these pages have are boilerplate. Their words are removed, the
unique runs of a block stay. Copies (pages with equal streams) are one page.
Documents share passages, so in articles nearly all pages have to have a run.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekly_mart.llm.common import forget, materialise, maybe_in, membership
from weekly_mart.llm.html_blocks import ARTICLE, FURNITURE, OPEN, blocks
from weekly_mart.llm.textscan import chunks, mix

#: Words of the shortest repeated run that counts; a shorter block counts as a whole.
RUN_WORDS = 8
#: A run is boilerplate where the lower confidence bound of the share of the host's distinct pages
#: that have it reaches this: in open blocks, and in articles. `CONFIDENCE` is the square of the bound's z.
OPEN_SHARE, ARTICLE_SHARE, CONFIDENCE = 0.48, 0.81, 2.2
#: Words of one suffix array, on average; larger hosts are dealt over several.
ARRAY_WORDS = 50_000
#: Passes over the pages, so that the shuffle files of one pass exist at a time.
PASSES = 6


def suffix_groups(stream: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array rank of every position by its first ``depth`` (a power of two) tokens.

    Prefix doubling; positions with equal rank start equal token runs. Longer
    repeats are chains of these, so the order beyond ``depth`` is not needed.
    """
    _, rank = np.unique(stream, return_inverse=True)
    length = 1
    while length < depth:
        after = np.full(len(rank), -1, np.int64)
        after[:-length] = rank[length:]
        _, rank = np.unique(rank * (len(rank) + 2) + after + 1, return_inverse=True)
        length *= 2
    return rank


def _digest(items: list) -> str:
    return blake2b(repr(items).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


_BLOCKS = pa.list_(pa.struct([("place", pa.int32()), ("text", pa.string())]))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every page: id, url, host, digest of its blocks, its words, and the blocks."""
    for batch in batches:
        ids, urls, hosts, pages = batch.columns
        found = [blocks(page or "") for page in pages.to_pylist()]
        words = [sum(text.count(" ") + 1 for _, text in page) for page in found]
        listed = [[{"place": where, "text": text} for where, text in page] for page in found]
        yield pa.RecordBatch.from_arrays(
            [ids, urls, hosts, pa.array(map(_digest, found), pa.string()), pa.array(words, pa.int64()), pa.array(listed, _BLOCKS)],
            names=["_id", "_url", "host", "content", "words", "blocks"],
        )


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the texts, the same on every machine, and the words of each text."""
    hashes, lengths = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for c in chunks(texts):
        starts, ends = c.words()
        hashes.append(c.hashes(starts, ends))
        lengths.append(np.diff(np.searchsorted(starts, c.bounds)))
    return np.concatenate(hashes), np.concatenate(lengths).astype(np.int64)


def _run_digests(own: np.ndarray, lengths: np.ndarray, depth: int) -> tuple[np.ndarray, ...]:
    """Runs of ``depth`` words, or a whole shorter text: text, first word in it, words, and digest."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    inside = np.arange(len(own)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    first = np.flatnonzero((lengths[text] - inside >= depth) | (inside == 0))
    size = np.minimum(lengths[text[first]], depth)
    digest = np.where(size < depth, np.uint64(1), np.uint64(0))
    for k in range(depth):
        nxt = mix(digest * np.uint64(0x2545F4914F6CDD1D) + own[np.minimum(first + k, len(own) - 1)])
        digest = np.where(size > k, nxt, digest)
    return text[first], inside[first], size, digest


def _candidates(depth: int, share: float):
    def run(cell: pa.Table) -> pa.Table:
        """Runs that at least the share of the cell's pages have, by the cell's suffix array."""
        host = cell["host"][0].as_py()
        texts = [page for page in cell["texts"].to_pylist() if page]
        if not texts:
            return pa.table({"host": pa.array([], pa.string()), "digest": pa.array([], pa.int64())})
        content = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        own, lengths = _words(pa.array([block for t in texts for block in t], pa.string()))
        # each block ends in tokens of its own, so no run crosses it
        starts = np.cumsum(lengths + depth) - lengths - depth
        stream = np.arange(int((lengths + depth).sum()), dtype=np.uint64)
        at = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(len(own))
        stream[at] = own | np.uint64(1 << 63)
        text, inside, size, digest = _run_digests(own, lengths, depth)
        group = np.where(size < depth, -1, suffix_groups(stream, depth)[starts[text] + inside])
        page = content[text]
        order = np.lexsort((page, digest, group))
        g, d, p = group[order], digest[order], page[order]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])))
        heads = np.flatnonzero(new)
        other = new | np.concatenate(([True], p[1:] != p[:-1]))
        n = np.add.reduceat(other.astype(np.int64), heads)
        often = heads[n >= share * len(texts)]
        return pa.table({"host": pa.array([host] * len(often), pa.string()), "digest": d[often].view(np.int64)})

    return run


def _places(depth: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Where the blocks of a page have candidate runs of its host."""
        for batch in batches:
            hosts, contents, pages, known = batch.columns
            for k, found in enumerate(pages.to_pylist()):
                own, lengths = _words(pa.array([b["text"] for b in found], pa.string()))
                if not len(own):
                    continue
                text, inside, size, digest = _run_digests(own, lengths, depth)
                hit = np.isin(digest.view(np.int64), known[k].values.to_numpy())
                text, n = text[hit], int(hit.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([hosts[k].as_py()] * n, pa.string()), pa.array([contents[k].as_py()] * n, pa.string()),
                        pa.array(digest[hit].view(np.int64)), pa.array(np.array([b["place"] for b in found], np.int32)[text]),
                        pa.array(text.astype(np.int32)), pa.array(inside[hit]), pa.array(size[hit]),
                    ],
                    names=["host", "content", "digest", "place", "block", "start", "size"],
                )

    return run


def _reaches(n: Column, pages: Column, share: float) -> Column:
    """Whether the lower confidence bound (Wilson) of n of the pages is ``share`` or more."""
    p, z2 = n / pages, F.lit(CONFIDENCE)
    spread = F.sqrt(z2 * (p * (1 - p) / pages + z2 / (4 * pages * pages)))
    return (p + z2 / (2 * pages) - spread) / (1 + z2 / pages) >= share - 1e-12


def _in_pass(k: int, *cols: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(10), *cols), F.lit(PASSES)) == k


def _all(tables: list[DataFrame]) -> DataFrame:
    every = tables[0]
    for more in tables[1:]:
        every = every.unionByName(more)
    return every


def boilerplate_runs(
    parsed: DataFrame, *, run_words: int = RUN_WORDS, array_words: int = ARRAY_WORDS,
) -> DataFrame:
    """(host, content, runs): places outside furniture of the runs that a host repeats, for each distinct page.

    ``parsed`` (a written table) has host, content, words and blocks. A run is
    repeated where the share of the host's distinct pages that have it is surely
    `OPEN_SHARE` or more, in articles `ARTICLE_SHARE`: one rule for hosts of any
    size, by the lower confidence bound of the share, which few pages hardly
    move. Pages with equal blocks are one. A host of any size is dealt over as
    many suffix arrays as it needs. What has the share in the host has it in at
    least one of these, so each hands on the runs that have it there; these
    candidates are then counted in all pages of the host.

    Scale: blocks are shuffled in `PASSES` passes, over suffix arrays and then
    over pages, so disk holds a share of them at a time, however large a host is.
    """
    worded = parsed.where("words > 0")
    classes = worded.groupBy("host", "content").agg(F.max("words").alias("words"))
    hosts = materialise(
        classes.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), F.sum("words").alias("all_words")), "page-hosts"
    )
    # hosts of more than one array, in a table of their own, so that its size decides how it is joined
    large = materialise(
        hosts.select(F.col("host").alias("_host"), F.ceil(F.col("all_words") / array_words).cast("long").alias("parts"))
        .where("parts > 1"),
        "page-large-hosts",
    )
    part = F.pmod(F.xxhash64("content"), F.coalesce("parts", F.lit(1).cast("long")))
    celled = worded.join(large, F.col("host") == F.col("_host"), "left").select(
        "host", part.alias("part"), "content", F.transform("blocks", lambda b: b.text).alias("texts")
    )
    # one page of each class; copies are combined before the shuffle
    cells = [
        materialise(
            celled.where(_in_pass(k, "host", "part")).groupBy("host", "part", "content").agg(F.first("texts").alias("texts"))
            .groupBy("host", "part").applyInArrow(_candidates(run_words, OPEN_SHARE), "host string, digest long"),
            "page-cells",
        )
        for k in range(PASSES)
    ]
    candidates = materialise(_all(cells).groupBy("host").agg(F.collect_set("digest").alias("known")), "page-candidates")
    # pages of hosts without candidates stay behind
    named = membership(candidates, "host")
    met = maybe_in(worded, named, "host", flag="met").where("met")
    places = [
        materialise(
            met.where(_in_pass(k, "host", "content")).groupBy("host", "content").agg(F.first("blocks").alias("blocks"))
            .join(candidates, "host").select("host", "content", "blocks", "known").mapInArrow(
                _places(run_words),
                "host string, content string, digest long, place int, block int, start long, size long",
            ),
            "page-runs",
        )
        for k in range(PASSES)
    ]
    written, places = [hosts, large, *cells, candidates, named, *places], _all(places)
    n, pages = F.col("n"), F.col("pages")
    repeated = (
        places.groupBy("host", "digest").agg(F.countDistinct("content").alias("n"))
        .join(hosts, "host").where(_reaches(n, pages, OPEN_SHARE))
        .select("host", "digest", _reaches(n, pages, ARTICLE_SHARE).alias("everywhere"))
    )
    runs = materialise(
        places.where(F.col("place") != FURNITURE).join(repeated, ["host", "digest"])
        .where((F.col("place") == OPEN) | F.col("everywhere"))
        .groupBy("host", "content").agg(F.collect_set(F.struct("block", "start", "size")).alias("runs")),
        "page-repeats",
    )
    forget(*written)
    return runs


def _left(text: str, runs: list[dict]) -> str:
    """The words of a block that no run covers."""
    words = text.split(" ")
    for run in runs:
        words[run["start"] : run["start"] + run["size"]] = [""] * run["size"]
    return " ".join(w for w in words if w)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, urls, pages, repeats = batch.columns
        texts = []
        for found, runs in zip(pages.to_pylist(), repeats.to_pylist(), strict=True):
            gone: dict[int, list] = {}
            for run in runs or []:
                gone.setdefault(run["block"], []).append(run)
            kept = [
                _left(b["text"], gone[k]) if k in gone else b["text"]
                for k, b in enumerate(found) if b["place"] != FURNITURE
            ]
            texts.append("\n\n".join(t for t in kept if t))
        yield pa.RecordBatch.from_arrays([ids, urls, pa.array(texts, pa.string())], names=["_id", "_url", "text"])


def extract_text(
    pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    run_words: int = RUN_WORDS, array_words: int = ARRAY_WORDS,
) -> DataFrame:
    """Per row: id, url, ``text`` and ``n_chars`` (code points).

    A page gives its blocks outside furniture, without the runs of words that
    its host repeats (`boilerplate_runs`): in blocks of an article (an article or
    main element) those that nearly all distinct pages of the host have, in open
    blocks, beside an article or without any, those that half of them have.
    Blocks are joined by two newlines. Null and empty pages give an empty text;
    a null url is a host of its own. Pages with equal blocks give equal texts
    and count as one page. An empty table gives an empty result. Only the three
    named columns are read.

    Scale: pages are parsed once and their blocks written, compressed; no html is
    shuffled. Pages without repeated runs give their text as they are read; of the
    others the blocks outside furniture meet their runs by a shuffle.
    """
    url = F.col(url_col).cast("string")
    narrow = pages.select(
        F.col(id_col).alias("_id"), url.alias("_url"),
        F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][^:/]*://([^/?#]*)", 1)).alias("host"),
        F.col(html_col).cast("string").alias("html"),
    )
    kind = narrow.schema["_id"].dataType.simpleString()
    parsed = materialise(
        narrow.mapInArrow(
            _parsed,
            f"_id {kind}, _url string, host string, content string, words long, blocks array<struct<place:int,text:string>>",
        ),
        "page-blocks", compression="zstd",
    )
    repeats = boilerplate_runs(parsed, run_words=run_words, array_words=array_words)
    tagged = maybe_in(parsed, membership(repeats, "host", "content"), "host", "content", flag="met")
    # a block keeps its number; what stands in furniture gives no text
    shown = F.transform(
        "blocks", lambda b: F.struct(b.place.alias("place"), F.when(b.place != FURNITURE, b.text).otherwise("").alias("text"))
    )
    repeats = repeats.select(F.col("host").alias("_host"), F.col("content").alias("_content"), "runs")
    met = tagged.where("met").select("_id", "_url", "host", "content", shown.alias("blocks")).join(
        repeats, (F.col("host") == F.col("_host")) & (F.col("content") == F.col("_content")), "left"
    )
    alone = tagged.where("NOT met").select("_id", "_url", "blocks", F.lit(None).cast(met.schema["runs"].dataType).alias("runs"))
    texts = alone.unionByName(met.select("_id", "_url", "blocks", "runs")).mapInArrow(_texts, f"_id {kind}, _url string, text string")
    return texts.select(
        F.col("_id").alias(id_col), F.col("_url").alias(url_col), "text",
        F.length("text").cast("long").alias("n_chars"),
    )
