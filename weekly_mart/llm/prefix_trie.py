"""Operator 11: prefix trie of rebuilt conversations by composable fingerprints.

The fingerprint of a sequence of turns is its polynomial in four random bases
modulo a prime. Fingerprints form a monoid: that of two sequences one after the
other follows from theirs and the length of the first. So a rebuilt
conversation (the head of its base, then its own turns) gets the fingerprints
of all its prefixes from the prefix fingerprints of the two stored
conversations; no rebuilt sequence of texts is ever made.

Turns are stored once and referred to by the SHA-256 of role and text. Members
of a node must agree in their parent and in the turn they refer to, which by
induction over the depth makes their whole prefixes equal; where they do not,
two sequences had one fingerprint and the trie is built again with other bases.

Sums over subtrees need no walk from level to level. Below any node, each node
counts for its smallest member, and a conversation is the smallest member of a
stretch of its path that reaches to its end. So every sum over a subtree is a
sum over the node's members of one number each conversation has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weekly_mart.llm.common import materialise

#: Bases are numbers modulo this prime; four of them make a fingerprint of 124 bits.
PRIME = (1 << 31) - 1
LANES = 4
#: Conversations that share a base, and the largest head plus one.
GROUP, HEADS = 20, 4
#: Turns a conversation can have, as a power of two.
TURN_BITS = 40
#: Ids one piece of a list of ends covers.
PIECE_IDS = 1024

_OUTSIDE_WORDS = "\t\n\v\f\r"


def _bases(seed: int) -> list[int]:
    return [int(b) for b in np.random.default_rng(seed).integers(1 << 16, PRIME, LANES)]


def _lanes(name: str) -> list[str]:
    return [f"{name}{j}" for j in range(LANES)]


def _power(base: int, n: Column) -> Column:
    """base ** n modulo the prime."""
    out = F.lit(1).cast("long")
    for k in range(TURN_BITS):
        factor = F.when(F.shiftright(n, k) % 2 == 1, F.lit(pow(base, 1 << k, PRIME))).otherwise(F.lit(1))
        out = out * factor % PRIME
    return out


def _powers(base: int, n: np.ndarray) -> np.ndarray:
    out, square = np.ones(len(n), np.int64), base
    for k in range(int(n.max(initial=0)).bit_length()):
        out = np.where(n >> k & 1, out * square % PRIME, out)
        square = square * square % PRIME
    return out


def _prefixes(bases: list[int]):
    """Fingerprints of the prefixes of each conversation's stretch within a sorted partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        last, count, n_words, sums = None, 0, 0, [0] * len(bases)
        for batch in batches:
            n = batch.num_rows
            if n == 0:
                continue
            conv = batch.column("conv").to_numpy()
            words = batch.column("words").to_numpy()
            turn = batch.column("turn")
            start = np.frombuffer(turn.buffers()[1], np.int32)[turn.offset]
            ends = np.frombuffer(turn.buffers()[2], np.uint8)[start : start + 32 * n].view("<u4").reshape(n, 8)
            first = np.flatnonzero(np.concatenate(([True], conv[1:] != conv[:-1])))
            stretch = np.repeat(first, np.diff(np.append(first, n)))
            goes_on = (stretch == 0) & (conv[0] == last)
            at = np.arange(n) - stretch + np.where(goes_on, count, 0)
            total = np.cumsum(words)
            total = total - (total - words)[stretch] + np.where(goes_on, n_words, 0)
            columns = {"conv": pa.array(conv), "part": pa.array(np.full(n, part, np.int64)), "at": pa.array(at)}
            columns |= {"words": pa.array(words), "total": pa.array(total), "turn": turn}
            for j, base in enumerate(bases):
                term = (ends[:, j].astype(np.int64) % (PRIME - 1) + 1) * _powers(base, at) % PRIME
                run_sum = np.cumsum(term)
                upto = (run_sum - (run_sum - term)[stretch] + np.where(goes_on, sums[j], 0)) % PRIME
                columns[f"s{j}"], columns[f"e{j}"] = pa.array(upto), pa.array((upto - term) % PRIME)
                sums[j] = int(upto[-1])
            last, count, n_words = conv[-1], int(at[-1]) + 1, int(total[-1])
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _stored_turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str, bases: list[int]) -> DataFrame:
    """(conv, pos, words, total, turn, s*, e*): each turn with the fingerprints of its conversation up to
    and before it; ``total`` counts words up to it."""
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    by = F.coalesce(F.col(role).cast("string"), F.lit(""))
    spaced = F.translate(said, _OUTSIDE_WORDS, " " * len(_OUTSIDE_WORDS))
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"), F.col(turn).alias("order"),
        F.size(F.array_remove(F.split(spaced, " "), "")).cast("long").alias("words"),
        F.unhex(F.sha2(F.concat(F.length(by).cast("string"), F.lit(":"), by, said), 256)).alias("turn"),
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["conv", "order", "turn", "row"]
    kind = "conv long, part long, at long, words long, total long, turn binary, " + ", ".join(
        f"s{j} long, e{j} long" for j in range(LANES)
    )
    stretches = materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .select("conv", "words", "turn").mapInArrow(_prefixes(bases), kind),
        "trie-stretches",
    )
    # a conversation that goes on in a later partition: what came before it, one row a partition at most
    parts = stretches.groupBy("conv", "part").agg(
        F.max(F.struct("at", "total", *_lanes("s"))).alias("end")
    ).select("conv", "part", (F.col("end.at") + 1).alias("n"), "end.*")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shifted = parts.withColumn("n0", F.sum("n").over(before)).withColumn("w0", F.sum("total").over(before))
    shifted = shifted.withColumns({f"b{j}": _power(b, F.coalesce("n0", F.lit(0))) for j, b in enumerate(bases)})
    shifted = shifted.withColumns(
        {f"z{j}": F.sum(F.col(f"s{j}") * F.col(f"b{j}") % PRIME).over(before) % PRIME for j in range(LANES)}
    )
    offsets = materialise(
        shifted.where("n0 > 0").select(
            F.col("conv").alias("_conv"), F.col("part").alias("_part"), "n0", "w0", *_lanes("b"), *_lanes("z")
        ),
        "trie-offsets",
    )
    joined = stretches.join(offsets, (F.col("conv") == F.col("_conv")) & (F.col("part") == F.col("_part")), "left")

    def moved(name: str, j: int) -> Column:
        behind = (F.col(f"z{j}") + F.col(f"b{j}") * F.col(f"{name}{j}")) % PRIME
        return F.when(F.col("n0").isNull(), F.col(f"{name}{j}")).otherwise(behind).alias(f"{name}{j}")

    return joined.select(
        "conv", (F.col("at") + F.coalesce("n0", F.lit(0))).alias("pos"), "words",
        (F.col("total") + F.coalesce("w0", F.lit(0))).alias("total"), "turn",
        *[moved(name, j) for j in range(LANES) for name in ("s", "e")],
    )


def _key(lanes: list[Column], a: str, b: str) -> list[Column]:
    return [
        lanes[0].bitwiseOR(F.shiftleft(lanes[1], 31)).alias(a), lanes[2].bitwiseOR(F.shiftleft(lanes[3], 31)).alias(b)
    ]


def _members(turns: DataFrame, bases: list[int]) -> tuple[DataFrame, DataFrame]:
    """One row for each conversation and node on its path, and one row for each conversation.

    Members: conv, depth, k1, k2 (the node), p1, p2 (its parent), turn, words (of the last turn),
    before (words of the turns above it), all_words and ends (whether the path ends here).
    """
    turn = F.struct("pos", "words", "total", "turn", *_lanes("s"), *_lanes("e"))
    stored = materialise(
        turns.groupBy("conv").agg(
            (F.max("pos") + 1).alias("n"), F.max("total").alias("total"),
            F.sort_array(F.collect_list(F.when(F.col("pos") < HEADS - 1, turn))).alias("first"),
        ),
        "trie-conversations",
    )
    base = stored.select(F.col("conv").alias("_base"), F.col("first").alias("_first"))
    plan = (
        stored.withColumn("h", (F.crc32(F.col("conv").cast("string")) % HEADS).cast("int"))
        .withColumn("base", F.col("conv") - F.col("conv") % GROUP)
        .join(base, F.col("base") == F.col("_base"), "left")
        .withColumn("head", F.slice(F.coalesce("_first", F.array().cast(stored.schema["first"].dataType)), F.lit(1), F.col("h")))
        .withColumn("m", F.size("head"))
        .withColumn("skipped", F.when(F.col("n") > F.col("h"), F.get("first", F.col("h") - 1)))
        .withColumn("top", F.get("head", F.col("m") - 1))
    )
    own_words = F.when(F.col("n") > F.col("h"), F.col("total") - F.coalesce("skipped.total", F.lit(0)))
    plan = materialise(
        plan.select(
            F.col("conv").alias("_conv"), "h", "m", "head", "top", "skipped",
            (F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
            (F.coalesce("top.total", F.lit(0)) + F.coalesce(own_words, F.lit(0))).alias("all_words"),
        ),
        "trie-plan",
    )
    zero = [F.lit(0).cast("long")] * LANES
    shape = ["conv", "depth", "k1", "k2", "p1", "p2", "turn", "words", "before", "all_words", "ends"]
    roots = plan.select(
        F.col("_conv").alias("conv"), F.lit(0).cast("long").alias("depth"), *_key(zero, "k1", "k2"),
        *_key(zero, "p1", "p2"), F.lit(b"").alias("turn"), F.lit(0).cast("long").alias("words"),
        F.lit(0).cast("long").alias("before"), "all_words", (F.col("length") == 0).alias("ends"),
    )
    heads = plan.select("_conv", "length", "all_words", F.explode_outer("head").alias("t")).where("t IS NOT NULL").select(
        F.col("_conv").alias("conv"), (F.col("t.pos") + 1).alias("depth"),
        *_key([F.col(f"t.s{j}") for j in range(LANES)], "k1", "k2"),
        *_key([F.col(f"t.e{j}") for j in range(LANES)], "p1", "p2"),
        "t.turn", "t.words", (F.col("t.total") - F.col("t.words")).alias("before"), "all_words",
        (F.col("length") == F.col("t.pos") + 1).alias("ends"),
    )

    def composed(name: str, j: int) -> Column:
        """Head, then the own turns behind the skipped ones, which start at h and move to m."""
        top, skipped = (F.coalesce(F.col(f"{c}.s{j}"), F.lit(0)) for c in ("top", "skipped"))
        back = F.lit(1)
        for gap in range(1, HEADS):
            back = F.when(F.col("h") - F.col("m") == gap, F.lit(pow(bases[j], -gap, PRIME))).otherwise(back)
        return (top + (F.col(f"{name}{j}") - skipped + PRIME) % PRIME * back) % PRIME

    depth = F.col("m") + F.col("pos") - F.col("h") + 1
    above = F.coalesce("top.total", F.lit(0)) - F.coalesce("skipped.total", F.lit(0))
    own = turns.join(plan.drop("head"), F.col("conv") == F.col("_conv")).where("pos >= h").select(
        "conv", depth.cast("long").alias("depth"),
        *_key([composed("s", j) for j in range(LANES)], "k1", "k2"),
        *_key([composed("e", j) for j in range(LANES)], "p1", "p2"),
        "turn", "words", (above + F.col("total") - F.col("words")).alias("before"), "all_words",
        (F.col("length") == depth).alias("ends"),
    )
    members = roots.select(*shape).unionByName(heads.select(*shape)).unionByName(own.select(*shape))
    return materialise(members, "trie-members"), plan.select("_conv", "all_words")


def _ends(members: DataFrame) -> DataFrame:
    """(_d, _1, _2, ends_sha256): hash of the list of conversations that end at a node.

    Lists are put together from pieces of a bounded range of ids; only whole
    pieces of one node meet in a task, which reads them as a stream.
    """
    pieces = (
        members.where("ends").groupBy("depth", "k1", "k2", F.floor(F.col("conv") / PIECE_IDS).alias("piece"))
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_d", "_1", "_2", "ends_sha256"]
        node, digest = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*[batch.column(k).to_pylist() for k in ("depth", "k1", "k2", "ids")], strict=True):
                if key == node:
                    digest.update(b",")
                else:
                    if node:
                        done.append((*node, digest.hexdigest()))
                    node, digest = key, hashlib.sha256()
                digest.update(ids.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, digest.hexdigest())], names=names)

    order = ["depth", "k1", "k2", "piece"]
    return (
        pieces.repartition("depth", "k1", "k2").sortWithinPartitions(*order)
        .mapInArrow(run, "_d long, _1 long, _2 long, ends_sha256 string")
    )


def prefix_trie(
    conversations: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text", seed: int = 11,
) -> DataFrame:
    """One row for each node of the trie of all rebuilt conversations.

    Columns: ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and
    ``ends_sha256``. A conversation is the first h stored turns of the one its
    group is based on, then its own turns after its first h.

    Rows without a conversation id belong to none and are left out. Turns stand
    in the order of ``turn_col``, null first; ties in the order of the SHA-256 of
    role and text; repeated rows are turns of their own. Null roles and texts are
    empty. A conversation that has no turn left is a member of the root. An empty
    table has no root. Other columns are not read.

    Scale: turns are sorted by range, so a conversation of any length is spread
    over partitions, whose stretches are composed from one row a partition. Nodes
    are combined before the shuffle; joins on conversations and parents are
    plain ones, whose hot keys AQE splits. The hash of a node's ends is taken by
    one task, as SHA-256 asks for, over pieces of up to 1,024 ids.
    """
    while True:
        bases = _bases(seed)
        turns = _stored_turns(conversations, conv_col, turn_col, role_col, text_col, bases)
        members, all_words = _members(turns, bases)
        nodes = materialise(
            members.groupBy("depth", "k1", "k2").agg(
                F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
                F.max("before").alias("before"), F.sum("all_words").alias("all_words"),
                F.min(F.struct("p1", "p2", "turn")).alias("least"), F.max(F.struct("p1", "p2", "turn")).alias("most"),
            ),
            "trie-nodes",
        )
        if nodes.where("least <> most").isEmpty():
            break
        seed += 1
    nodes = nodes.select("depth", "k1", "k2", "least.p1", "least.p2", "rep", "n_convs", "words", "before", "all_words")
    below = nodes.where("depth > 0").groupBy(
        (F.col("depth") - 1).alias("_d"), F.col("p1").alias("_1"), F.col("p2").alias("_2")
    ).agg(F.count(F.lit(1)).alias("n_children"))

    def at_node(depth: Column, a: str, b: str) -> Column:
        return (depth == F.col("_d")) & (F.col(a) == F.col("_1")) & (F.col(b) == F.col("_2"))

    here = F.col("depth")
    nodes = materialise(
        nodes.join(below, at_node(here, "k1", "k2"), "left").drop("_d", "_1", "_2")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0))),
        "trie-nodes",
    )
    # for each conversation: the words and the leaves of the nodes whose smallest member it is
    stands_for = nodes.groupBy(F.col("rep").alias("_rep")).agg(
        F.sum("words").alias("own_words"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves")
    )
    shares = materialise(
        all_words.withColumnRenamed("all_words", "rep_words").join(stands_for, F.col("_conv") == F.col("_rep"), "left")
        .select("_conv", "rep_words", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("own_words", "leaves")]),
        "trie-shares",
    )
    sums = materialise(
        members.select("conv", "depth", "k1", "k2").join(shares, F.col("conv") == F.col("_conv"))
        .groupBy(F.col("depth").alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"))
        .agg(F.sum("own_words").alias("own_sum"), F.sum("leaves").alias("n_leaves")),
        "trie-sums",
    )
    parents = nodes.select(
        F.col("depth").alias("_d"), F.col("k1").alias("_1"), F.col("k2").alias("_2"), F.col("rep").alias("parent_conv_id")
    )
    ends = materialise(_ends(members), "trie-ends")
    # words of all members from this node on, less those that are said once: each other member's own
    # nodes, and the path of the smallest member
    saved = (
        F.col("all_words") - F.col("n_convs") * F.col("before") - (F.col("own_sum") - F.col("own_words"))
        - (F.col("rep_words") - F.col("before"))
    )
    drop = ("_d", "_1", "_2")
    return (
        nodes.join(sums, at_node(here, "k1", "k2")).drop(*drop)
        .join(shares.drop("leaves"), F.col("rep") == F.col("_conv"))
        .join(ends, at_node(here, "k1", "k2"), "left").drop(*drop)
        .join(parents, at_node(here - 1, "p1", "p2"), "left").drop(*drop)
        .select(
            F.col("rep").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
            saved.alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        )
    )
