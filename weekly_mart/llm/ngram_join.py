"""Operator 6: n-gram Jaccard self-join by T-occurrence search (DivideSkip).

Two documents link when the Jaccard similarity of their word-shingle sets
reaches a threshold; linked documents form components.

1. Texts with equal sets form classes; from here on one text stands for each.
2. Every set is ordered by hash, and its first tokens are its prefix, long
   enough that linked sets share at least T tokens of their prefixes. Tokens
   that one class only has are dropped, and, as in DivideSkip, the T - 1 longest
   lists of each set are left out of the merge: linked sets still meet in one of
   the others. Each list contributes edges to its first class, never pairs.
   The components of these edges are blocks; links lie within blocks. Tokens are
   dealt over passes, so the shuffle files of one pass exist at a time.
3. Inside blocks, dealt over cells of bounded size, the T-occurrence search
   runs on the whole sets: the short inverted lists are merged, candidates with
   enough hits are probed in the long lists by binary search, and the exact
   overlap decides. Sets already connected are not looked at again.
   A block that is too large for one cell is first split by step 2 over whole
   sets, where T is the full overlap and only the rarest fifth of a set's lists
   is left. What is too large even so is cut at random; every part also holds a
   few common sets, which connects a group of near copies across parts. The sets
   outside the block's largest component are then searched against all parts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weekly_mart.llm.common import bound_batches, forget, materialise, maybe_in, membership, packed, unpacked
from weekly_mart.llm.components import components
from weekly_mart.llm.textscan import LOWER, Chunk, chunks, mix, windows

SHINGLE_WORDS = 5
#: Similarity in hundredths.
PERCENT = 80
#: Shared prefix tokens that are asked for, at least and as hundredths of the set.
OVERLAP, OVERLAP_PERCENT = 16, 15
#: Bounds of a block in one cell: shingles and sets. Cells are filled with small blocks up to a fraction of that.
CELL_SHINGLES, CELL_SETS = 3_000_000, 8_000
FILL = 8
#: Passes over the tokens.
PASSES = 2
#: One class in so many shows which tokens are hot: seen so often in them, and so many of them at most.
#: Lists of up to about 65,000 sets (2 MB) are no matter for one task.
HOT_SAMPLE, HOT_SEEN, HOT_TOKENS = 64, 1024, 50_000
#: Sets that every part of a large block holds.
PIVOTS = 16
#: Searches in a block before one of its components is fixed.
ANCHOR_AFTER = 16
#: Cost of a probe against that of a merge step, as in the published heuristic.
MU = 0.0085
#: Steps of a merge that one binary probe takes as long as.
PROBE = 16


def _needed(n, percent: int):
    """Least overlap of a set of n with any set linked to it."""
    return (percent * n + 99) // 100


def _asked(n, percent: int):
    """Shared prefix tokens asked for; grows with n."""
    return np.minimum(_needed(n, percent), np.maximum(OVERLAP, (OVERLAP_PERCENT * n + 99) // 100))


def shingle_sets(c: Chunk, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text of a chunk, ascending, and where each text's begin.

    A text with fewer words than ``size`` has its whole sequence as its shingle.
    """
    starts, ends = c.words()
    words = c.hashes(starts, ends, LOWER)
    text_of, first = c.texts_of(starts), c.first_of(starts)
    hashes, at = windows(words, text_of, size)
    owner = text_of[at]
    n_words = np.diff(first)
    for k in range(1, size):
        few = np.flatnonzero(n_words == k)
        if len(few):
            whole = np.zeros(len(few), np.uint64)
            for j in range(k):
                whole = mix(whole * np.uint64(0x2545F4914F6CDD1D) + words[first[few] + j])
            hashes, owner = np.concatenate((hashes, whole)), np.concatenate((owner, few))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    if len(hashes):
        fresh = np.concatenate(([True], (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])))
        hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.searchsorted(owner, np.arange(c.last - c.first + 1))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.LargeListArray.from_arrays(pa.array(bounds, pa.int64()), pa.array(values.view(np.int64)))


def _class_of(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """64-bit digest of each set."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)))))
    n = np.diff(bounds).astype(np.uint64)
    return mix(sums[bounds[1:]] - sums[bounds[:-1]] + n * np.uint64(0x9E3779B97F4A7C15)).view(np.int64)


def _prefixes(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.columns
            for c in chunks(text):
                hashes, bounds = shingle_sets(c, size)
                n = np.diff(bounds)
                length = n - _needed(n, percent) + _asked(n, percent)
                ends = np.concatenate(([0], np.cumsum(length)))
                pick = np.arange(ends[-1]) + np.repeat(bounds[:-1] - ends[:-1], length)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(c.first, c.last - c.first),
                        pa.array(n.astype(np.int64)),
                        pa.array(_class_of(hashes, bounds)),
                        _lists(hashes[pick], ends).cast(pa.list_(pa.int64())),
                    ],
                    names=["_id", "n", "cls", "prefix"],
                )

    return run


def _classes(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, text = batch.columns
            for c in chunks(text):
                n = c.last - c.first
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(c.first, n),
                        pa.array(_class_of(*shingle_sets(c, size))),
                        text.slice(c.first, n),
                    ],
                    names=["_id", "cls", "text"],
                )

    return run


def divide_skip(
    hashes: np.ndarray, bounds: np.ndarray, label: np.ndarray, query: np.ndarray, percent: int,
    block: np.ndarray | None = None,
) -> np.ndarray:
    """Labels after connecting all linked sets of which one is a query.

    ``hashes`` holds the sets one after the other, each ascending. ``label``
    tells what is connected already; ``block`` says where links can be. The sets
    of a block that is wholly connected are not searched for any more. Where all
    sets are queries, one component of each block is fixed after a few searches,
    and sets that have joined it are not searched for: a link between it and
    another set is found from the other side.
    """
    n_sets, sizes = len(bounds) - 1, np.diff(bounds)
    by_size = np.argsort(sizes, kind="stable")
    place = np.empty(n_sets, np.int64)
    place[by_size] = np.arange(n_sets)
    sorted_sizes = sizes[by_size]
    _, token = np.unique(hashes, return_inverse=True)
    frequency = np.bincount(token)
    shared = frequency[token] > 1
    owner = np.repeat(np.arange(n_sets), sizes)
    # inverted lists: the places of the sets that have a token, ascending
    keys = np.sort(token[shared] * n_sets + place[owner[shared]])
    heads = np.searchsorted(keys, np.arange(len(frequency) + 1) * n_sets)
    postings = keys % n_sets
    label = label.copy()
    block = np.zeros(n_sets, np.int64) if block is None else np.unique(block, return_inverse=True)[1]
    # how many unconnected pieces each block is in
    pieces = np.bincount(np.unique(np.stack((block, label)), axis=1)[0], minlength=int(block.max(initial=-1)) + 1)
    anchor, searched = np.full(len(pieces), -1), np.zeros(len(pieces), np.int64)
    from_both_sides = bool(query.all())
    for x in np.flatnonzero(query):
        b = block[x]
        if pieces[b] < 2 or (anchor[b] >= 0 and label[anchor[b]] == label[x]):
            continue
        if from_both_sides and anchor[b] < 0:
            searched[b] += 1
            if searched[b] > ANCHOR_AFTER:
                members = np.flatnonzero(block == b)
                _, first, size = np.unique(label[members], return_index=True, return_counts=True)
                anchor[b] = members[first[size.argmax()]]
                if label[anchor[b]] == label[x]:
                    continue
        n = int(sizes[x])
        need = _needed(n, percent)
        mine = token[bounds[x] : bounds[x + 1]]
        mine = mine[frequency[mine] > 1]
        if n == 0 or len(mine) < need:
            continue
        mine = mine[np.argsort(frequency[mine], kind="stable")]
        longest = int(frequency[mine[-1]])
        skipped = min(need - 1, int(need / (MU * np.log2(longest + 1) + 1)))
        short, long = mine[: len(mine) - skipped], mine[len(mine) - skipped :]
        length = heads[short + 1] - heads[short]
        steps = np.concatenate(([0], np.cumsum(length)))
        merged = postings[np.arange(steps[-1]) + np.repeat(heads[short] - steps[:-1], length)]
        low = np.searchsorted(sorted_sizes, need)
        high = np.searchsorted(sorted_sizes, 100 * n // percent, "right")
        merged = merged[(merged >= low) & (merged < high)]
        if len(merged) > n_sets:
            hits = np.bincount(merged, minlength=n_sets)
            found = np.flatnonzero(hits >= need - skipped)
            hits = hits[found]
        else:
            found, hits = np.unique(merged, return_counts=True)
            enough = hits >= need - skipped
            found, hits = found[enough], hits[enough]
        other = (label[by_size[found]] != label[x]) & (block[by_size[found]] == block[x])
        found, hits = found[other], hits[other]
        # a probe costs as much as PROBE steps of a merge: many candidates are cheaper to count in full
        ends = heads[long + 1]
        counted = None
        if PROBE * len(found) * len(long) > (ends - heads[long]).sum():
            length = ends - heads[long]
            steps = np.concatenate(([0], np.cumsum(length)))
            rest = postings[np.arange(steps[-1]) + np.repeat(heads[long] - steps[:-1], length)]
            counted = np.bincount(rest, minlength=n_sets)
        while len(found):
            # the candidates with most hits first, then those of what is left that are still unconnected
            first = np.argsort(-hits, kind="stable")[:64]
            if counted is not None:
                overlap = hits[first] + counted[found[first]]
            else:
                probe = (long[:, None] * n_sets + found[first][None, :]).ravel()
                at = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
                overlap = hits[first] + (keys[at] == probe).reshape(len(long), -1).sum(0)
            union = n + sorted_sizes[found[first]] - overlap
            for y in by_size[found[first]][100 * overlap >= percent * union]:
                if label[y] != label[x]:
                    old, new = max(label[x], label[y]), min(label[x], label[y])
                    label[label == old] = new
                    pieces[block[x]] -= 1
            rest = np.ones(len(found), bool)
            rest[first] = False
            rest &= label[by_size[found]] != label[x]
            found, hits = found[rest], hits[rest]
    return label


def _search(size: int, percent: int):
    def run(cell: pa.Table) -> pa.Table:
        """Links between classes of one cell, each component as a star."""
        cell = cell.sort_by([("cls", "ascending"), ("query", "descending")])
        cls = cell["cls"].to_numpy()
        keep = np.concatenate(([True], cls[1:] != cls[:-1])) if len(cls) else np.zeros(0, bool)
        cell, cls = cell.filter(pa.array(keep)), cls[keep]
        parts, sizes = [], []
        for chunk in cell["text"].chunks:
            for c in chunks(chunk):
                hashes, bounds = shingle_sets(c, size)
                parts.append(hashes)
                sizes.append(np.diff(bounds))
        bounds = np.concatenate(([0], np.cumsum(np.concatenate(sizes))))
        _, label = np.unique(cell["known"].to_numpy(), return_inverse=True)
        query = cell["query"].to_numpy(zero_copy_only=False)
        block = cell["block"].to_numpy()
        label = divide_skip(np.concatenate(parts), bounds, label, query, percent, block)
        _, first, group = np.unique(label, return_index=True, return_inverse=True)
        head = first[group]
        linked = head != np.arange(len(cls))
        return pa.table({"a": cls[linked], "b": cls[head[linked]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _blocks(tokens: DataFrame, least: Column) -> DataFrame:
    """(node, root): sets that can link, with their block.

    ``tokens`` holds (cls, n, token), where ``cls`` numbers the sets; ``least`` is T, what any linked set shares
    of the tokens of a set of ``n``, whatever its size.
    """
    hot = materialise(
        tokens.where(F.pmod(F.xxhash64(F.lit(5), "cls"), F.lit(HOT_SAMPLE)) == 0)
        .groupBy("token").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") >= HOT_SEEN)
        .orderBy(F.desc("seen"), "token").limit(HOT_TOKENS).select("token", F.lit(True).alias("hot")),
        "hot-tokens",
    )
    marked = tokens.join(F.broadcast(hot), "token", "left")
    # lists that many tasks share: combined before the shuffle, and met again by a join that can be split
    mine = marked.where("hot").drop("hot")
    lists = (
        mine.groupBy("token")
        .agg(F.count(F.lit(1)).alias("length"), F.min("cls").alias("head"), F.max("cls").alias("tail"))
        .where("head <> tail").select("token", "length", "head")
    )
    kept = ("cls", "n", "length", "token", "head")
    shared = [materialise(mine.join(lists, "token").select(*kept), "shared-tokens")]
    # all others: each list is sorted together once
    inside = Window.partitionBy("token")
    for p in range(PASSES):
        rest = marked.where(F.col("hot").isNull() & (F.pmod("token", F.lit(PASSES)) == p)).drop("hot")
        listed = rest.withColumns({
            "length": F.count(F.lit(1)).over(inside), "head": F.min("cls").over(inside), "tail": F.max("cls").over(inside)
        })
        shared.append(materialise(listed.where("head <> tail").select(*kept), "shared-tokens"))
    every = shared[0]
    for more in shared[1:]:
        every = every.unionByName(more)
    roots = components(
        every.groupBy("cls", "n")
        .agg(F.sort_array(F.collect_set(F.struct("length", "token", "head"))).alias("lists"))
        .where(F.size("lists") >= least)
        .select("cls", F.explode(F.slice("lists", F.lit(1), F.size("lists") - least + 1)).alias("list"))
        .select(F.col("cls").alias("a"), F.col("list.head").alias("b")),
    )
    forget(hot, *shared)
    return roots


def _least(percent: int, *, whole: bool) -> Column:
    """T for sets of ``n``; with ``whole`` for whole sets, else for prefixes."""
    need = lambda n: F.floor((n * percent + 99) / 100)
    asked = lambda n: F.least(need(n), F.greatest(F.lit(OVERLAP), F.floor((n * OVERLAP_PERCENT + 99) / 100)))
    return (need(F.col("n")) if whole else asked(need(F.col("n")))).cast("int")


def _cell(*parts: Column) -> Column:
    return F.concat_ws("/", *[p.cast("string") for p in parts])


def jaccard_links(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    percent: int = PERCENT,
    cell_shingles: int = CELL_SHINGLES,
    cell_sets: int = CELL_SETS,
) -> tuple[DataFrame, DataFrame]:
    """The sets (id, n, cls, prefix) of all rows, and links (a, b) between classes.

    The links connect exactly the classes that chains of similar pairs connect.
    """
    bound_batches(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    kind = narrow.schema["_id"].dataType.simpleString()
    # rows are numbered, so that a shuffled token names its set by a few bytes rather than by a digest
    prefixes = materialise(
        narrow.mapInArrow(_prefixes(size, percent), f"_id {kind}, n long, cls long, prefix array<long>")
        .withColumn("row", F.monotonically_increasing_id()),
        "shingle-prefixes",
    )
    sets = materialise(prefixes.select("_id", "n", "cls", "row"), "sets")
    reps = materialise(
        sets.where("n > 0").groupBy("cls").agg(F.min("_id").alias("_id"), F.max("n").alias("n"), F.count(F.lit(1)).alias("m")),
        "classes",
    )
    # of a class with copies one row is enough; the filters let at least that one pass
    copied = reps.where("m > 1")
    once = maybe_in(
        maybe_in(prefixes.where("n > 0"), membership(copied, "cls"), "cls", flag="copied"),
        membership(copied, "cls", "_id"), "cls", "_id", flag="first",
    ).where("first OR NOT copied")
    blocks = materialise(
        _blocks(once.select(F.col("row").alias("cls"), "n", F.explode("prefix").alias("token")), _least(percent, whole=False)),
        "blocks",
    )
    forget(prefixes)
    placed_rows = blocks.select(F.col("node").alias("row"), F.col("root").alias("block")).join(sets, "row")
    members = materialise(
        placed_rows.groupBy("cls").agg(F.min("block").alias("block")).join(reps.drop("m"), "cls"), "members"
    )
    # one text for each class of a block; other rows stay behind before they are looked at again
    wanted = maybe_in(narrow, membership(members, "_id"), "_id", flag="member").where("member").drop("member")
    bodies = materialise(
        wanted.mapInArrow(_classes(size), f"_id {kind}, cls long, text string")
        .join(
            members.select(F.col("cls").alias("_cls"), F.col("_id").alias("_rep")),
            (F.col("cls") == F.col("_cls")) & F.col("_id").eqNullSafe(F.col("_rep")),
        )
        .groupBy("cls").agg(F.first("text").alias("text")),
        "block-texts",
    )
    placed = _placed(bodies, members.select("cls", "block", "n"), size, percent, cell_shingles, cell_sets)
    texts = bodies.join(placed, "cls")
    largest = placed.agg(F.coalesce(F.max("parts"), F.lit(0))).first()[0]
    part = F.pmod(F.xxhash64(F.lit(1), "cls"), F.col("parts"))
    shape = ("cell", "block", "cls", "known", "query", "text")
    whole = texts.where("parts = 1").select(
        _cell(F.lit("s"), F.col("bin"), F.col("cut")).alias("cell"),
        "block", "cls", F.col("cls").alias("known"), F.lit(True).alias("query"), "text",
    )
    rounds = [whole]
    if largest > 1:
        large = texts.where("parts > 1")
        pivots = (
            large.groupBy("block").agg(F.sort_array(F.collect_set(_smallest("cls"))).alias("p"))
            .select("block", F.explode(F.slice("p", 1, PIVOTS)).alias("_slot"))
        )
        first = (
            large.groupBy("block", _smallest("cls").alias("_slot")).agg(F.min("cls").alias("_cls"))
            .join(pivots, ["block", "_slot"]).select("_cls")
        )
        common = large.join(first, F.col("cls") == F.col("_cls")).withColumn(
            "_part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
        )
        own = large.withColumn("_part", part.cast("int"))
        rounds.append(
            own.select(*large.columns, "_part").unionByName(common.select(*large.columns, "_part"))
            .select(_cell(F.lit("l"), F.col("block"), F.col("_part")).alias("cell"), "block", "cls",
                    F.col("cls").alias("known"), F.lit(True).alias("query"), "text")
        )
    found = [_run_cells(r.select(*shape), size, percent) for r in rounds]
    links = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    if largest > 1:
        links = materialise(links, "links").unionByName(
            _across_parts(texts.where("parts > 1"), links, size, percent, cell_shingles, cell_sets)
        )
    return sets, links


def _placed(
    bodies: DataFrame, members: DataFrame, size: int, percent: int, cell_shingles: int, cell_sets: int
) -> DataFrame:
    """(cls, block, n, parts, bin, cut): each class with its block, the parts the block is cut into, and the
    cell of a block in one part.

    Blocks beyond the bounds are split by their whole sets before. The others
    are dealt over bins, and each bin is cut where its running size passes a
    share of the bounds, so a cell holds at most that and one block.
    """
    share = F.greatest(F.ceil(F.sum("n") / cell_shingles), F.ceil(F.count(F.lit(1)) / cell_sets)).cast("int")
    by_block = lambda df: materialise(
        df.groupBy("block").agg(share.alias("parts"), F.sum("n").alias("s"), F.count(F.lit(1)).alias("c")), "block-parts"
    )
    sizes = by_block(members)
    if not sizes.where("parts > 1").isEmpty():
        sized = members.join(sizes, "block")
        small, large = sized.where("parts = 1").select("cls", "block", "n"), sized.where("parts > 1")
        whole = materialise(
            bodies.join(large.select("cls", "block"), "cls").select("cls", "block", "text").mapInArrow(
                _whole_sets(size), "cls long, within long, n long, prefix array<long>"
            ),
            "whole-sets",
        )
        tokens = whole.select("cls", "n", "within", F.explode("prefix").alias("token")).select(
            "cls", "n", F.xxhash64("token", "within").alias("token")
        )
        finer = _blocks(tokens, _least(percent, whole=True)).select("node", F.col("root").alias("block"))
        split = large.drop("block").join(finer, F.col("cls") == F.col("node")).select("cls", "block", "n")
        members = materialise(small.unionByName(split), "members")
        forget(whole)
        sizes = by_block(members)
    load = F.greatest(F.col("s") / cell_shingles, F.col("c") / cell_sets) * FILL
    bins = sizes.where("parts = 1").agg(F.greatest(F.ceil(F.sum(load)), F.lit(1))).first()[0] or 1
    upto = Window.partitionBy("bin").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        sizes.where("parts = 1").withColumn("bin", F.pmod(F.xxhash64(F.lit(2), "block"), F.lit(bins)))
        .withColumn("cut", F.floor(F.coalesce(F.sum(load).over(upto), F.lit(0.0))))
        .select("block", "parts", "bin", "cut")
    )
    none = F.lit(None).cast("long")
    spread = sizes.where("parts > 1").select("block", "parts", none.alias("bin"), none.alias("cut"))
    return materialise(members.join(cut.unionByName(spread), "block"), "placed")


def _whole_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, block, text = batch.columns
            for c in chunks(text):
                n = c.last - c.first
                hashes, bounds = shingle_sets(c, size)
                yield pa.RecordBatch.from_arrays(
                    [
                        cls.slice(c.first, n), block.slice(c.first, n), pa.array(np.diff(bounds)),
                        _lists(hashes, bounds).cast(pa.list_(pa.int64())),
                    ],
                    names=["cls", "within", "n", "prefix"],
                )

    return run


def _smallest(col: str) -> Column:
    """One of a fixed number of slots, to name a bounded number of sets of a block."""
    return F.pmod(F.xxhash64(F.lit(3), col), F.lit(4 * PIVOTS))


def _run_cells(rows: DataFrame, size: int, percent: int) -> DataFrame:
    return materialise(
        rows.groupBy("cell").applyInArrow(_search(size, percent), "a long, b long"), "links"
    )


def _across_parts(
    large: DataFrame, links: DataFrame, size: int, percent: int, cell_shingles: int, cell_sets: int
) -> DataFrame:
    """Links of large blocks between sets outside the largest component and all others."""
    roots = materialise(components(links), "part-roots")
    known = materialise(
        large.select("cls", "block", "n").join(roots, F.col("cls") == F.col("node"), "left")
        .select("cls", "block", "n", F.coalesce("root", "cls").alias("known")),
        "part-known",
    )
    main = materialise(
        known.groupBy("block", "known").agg(F.count(F.lit(1)).alias("m")).groupBy("block")
        .agg(F.max(F.struct("m", "known")).alias("x")).select("block", F.col("x.known").alias("main")),
        "main",
    )
    stray = known.join(main, "block").where("known <> main")
    share = F.greatest(F.ceil(F.sum("n") / cell_shingles), F.ceil(F.count(F.lit(1)) / cell_sets))
    waves = materialise(stray.groupBy("block").agg(share.cast("int").alias("waves")), "waves")
    rows = (
        large.drop("n").join(known.drop("block", "n"), "cls").join(waves, "block").join(main, "block")
        .withColumn("is_stray", F.col("known") != F.col("main"))
    )
    part = F.pmod(F.xxhash64(F.lit(1), "cls"), F.col("parts"))
    wave = F.pmod(F.xxhash64(F.lit(4), "cls"), F.col("waves"))
    index = rows.select(
        "block", "cls", "known", "text", part.alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("waves").cast("long") - 1)).alias("j"), F.lit(False).alias("query"),
    )
    queries = rows.where("is_stray").select(
        "block", "cls", "known", "text",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts").cast("long") - 1)).alias("i"), wave.alias("j"),
        F.lit(True).alias("query"),
    )
    cells = index.unionByName(queries).select(
        _cell(F.col("block"), F.col("i"), F.col("j")).alias("cell"), "block", "cls", "known", "query", "text"
    )
    return _run_cells(cells, size, percent)


def jaccard_components(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE_WORDS,
    percent: int = PERCENT, cell_shingles: int = CELL_SHINGLES, cell_sets: int = CELL_SETS,
) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``.

    ``component_id`` is the smallest id that links reach, the row's own included.
    Texts that are null or have no words have an empty set and link with nothing,
    not even with each other. Equal sets link. Rows with equal ids are told apart
    by their sets; a null id never names a component (null where no row of the
    component has an id). An empty table gives an empty result. Sets are compared
    by 64-bit hashes of their shingles.
    """
    sets, links = jaccard_links(
        docs, id_col=id_col, text_col=text_col, size=size, percent=percent,
        cell_shingles=cell_shingles, cell_sets=cell_sets,
    )
    roots = components(links)
    classes = sets.where("n > 0").groupBy("cls").agg(F.min("_id").alias("rep"), F.count(F.lit(1)).alias("m"))
    named = materialise(
        classes.join(roots, F.col("cls") == F.col("node"), "left")
        .where("m > 1 OR root IS NOT NULL")
        .select("cls", "rep", F.coalesce("root", "cls").alias("root")),
        "class-roots",
    )
    least = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    answer = materialise(named.join(least, "root").select(F.col("cls").alias("_cls"), "component_id"), "answers")
    rows = sets.select("_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls"))
    return rows.join(answer, F.col("cls") == F.col("_cls"), "left").select(
        F.col("_id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("_cls").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def keep_one_of_each(docs: DataFrame, *, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with one row of each component, all columns unchanged, whatever their names.

    Rows are told apart by two hashes of all their columns; the row with the
    least of them stays, and repeated rows leave one. Rows without words, and
    rows whose text is null, all stay. An empty table stays empty.

    Scale: rows that are alone in their component pass as they are read; a
    filter of fixed size (`membership`) tells them apart. Of the others only
    those that a second filter takes for one that stays are shuffled.
    """
    key = F.concat_ws("-", *[F.hex(F.xxhash64(F.lit(k), "row")) for k in (1, 2)])
    keyed = packed(docs).select("row", F.col("row").getField(text_col).cast("string").alias("text"), key.alias("key"))
    found = materialise(
        jaccard_components(keyed.select("key", "text"), id_col="key", text_col="text", **options).where("n_shingles > 0"),
        "one-of-each",
    )
    copies = found.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.max("component_id").alias("component_id"))
    marked = materialise(copies.where("m > 1 OR key <> component_id").select("key", "component_id"), "marked")
    tagged = maybe_in(keyed, membership(marked, "key"), "key", flag="marked")
    # a marked row may stay if it stands for its component, or is marked by chance
    going = marked.where("key <> component_id").select("key")
    staying = found.join(going, "key", "left_anti").select("key")
    held = membership(maybe_in(staying, membership(marked, "key"), "key", flag="marked").where("marked"), "key")
    wordless = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    likely = maybe_in(tagged.where("marked").withColumn("wordless", wordless), held, "key", flag="stays")
    kept = likely.where("stays OR wordless").join(going, "key", "left_anti")
    one = kept.where("NOT wordless").groupBy("key").agg(F.first("row").alias("row"))
    rows = tagged.where("NOT marked").select("row").unionByName(one.select("row"))
    return unpacked(rows.unionByName(kept.where("wordless").select("row")), docs.columns)
