"""The trie of conversations' common beginnings, by the Euler tour of its nodes.

1. Turns are numbered within their conversation, and every conversation is rebuilt.
2. A node is a sequence of turns. Its key is the exclusive or of hashes of (depth, turn),
   so keys are running values that chunks of a long conversation compute apart.
3. Each node has an arc that enters it and one that leaves it. The successor of an arc
   follows from the first child and the next sibling: this is the Euler tour.
4. List ranking gives each arc its place in the tour: arcs jump by pointer doubling to the
   next of some arcs picked by hash, whose shorter list is ranked in the same way.
5. Prefix sums over the places give, between a node's two arcs, the leaves and the
   savings of its subtree.

No step gathers a conversation, a node's members or a node's children: sorted ranges,
chunks of fixed size and partial aggregates take their place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgrid.llm.common import SPACES, Scratch

# Rows of one window or one task, wherever rows are cut by their number.
_CHUNK = 4096
# One arc in so many is kept for the next, shorter list.
_PICKED = 64


def _ranged(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in ranges of their keys, each sorted. `at` numbers them in that order, without
    gaps inside a range, which `range_id` tells. To be written before it is used."""
    ranges = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return ranges.select(
        "*", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("range_id")
    )


def _numbered_turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """`conv_id, pos, t1, t2, words`: turns by their number from 0, texts by two hashes."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        F.xxhash64(role, text).alias("t1"),
        F.xxhash64(F.lit(1), text, role).alias("t2"),
        F.regexp_count(text, F.lit(f"[^{SPACES}]+")).cast("long").alias("words"),
    )
    turns = scratch.table("sorted", _ranged(turns, "conv_id", "turn", "t1", "t2"))
    parts = turns.groupBy("conv_id", "range_id").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")
    )
    earlier = Window.partitionBy("conv_id").orderBy("range_id").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("n").over(earlier), F.lit(0))
    parts = parts.select("conv_id", "range_id", (before - F.col("first")).alias("shift"))
    pos = (F.col("at") + F.col("shift")).alias("pos")
    return turns.join(parts, ["conv_id", "range_id"]).select("conv_id", pos, "t1", "t2", "words")


def _rebuilt(turns: DataFrame, every: int, heads: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(`conv_id, n_turns`) of every conversation, and its turns by `depth` from 1."""
    own = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    base = F.col("conv_id") - F.col("conv_id") % every
    convs = lengths.select("*", own.alias("h"), base.alias("base"))
    found = lengths.toDF("base", "base_length")
    convs = convs.join(found, "base", "left").select(
        "conv_id",
        "base",
        "h",
        F.least("h", F.coalesce("base_length", F.lit(0))).alias("taken"),
        F.greatest(F.col("length") - F.col("h"), F.lit(0)).alias("left"),
    )
    convs = scratch.table("convs", convs)
    rest = turns.join(convs.select("conv_id", "h", "taken"), "conv_id").where("pos >= h")
    rest = rest.select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "t1", "t2", "words"
    )
    first = turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base")
    first = convs.select("conv_id", "base", "h").join(first, "base").where("pos < h")
    first = first.select("conv_id", (F.col("pos") + 1).alias("depth"), "t1", "t2", "words")
    sizes = convs.select("conv_id", (F.col("taken") + F.col("left")).alias("n_turns"))
    return sizes, scratch.table("turns", rest.union(first))


def _prefixes(turns: DataFrame, sizes: DataFrame, chunk: int) -> DataFrame:
    """Each turn's node: its key `p1, p2`, its parent's `q1, q2`, and whether it is a last."""
    x1 = F.xxhash64("depth", "t1", "t2").alias("x1")
    x2 = F.xxhash64(F.lit(2), "t2", "depth", "t1").alias("x2")
    part = F.floor((F.col("depth") - 1) / chunk).alias("part")
    rows = turns.select("conv_id", "depth", "words", x1, x2, part)
    inside = Window.partitionBy("conv_id", "part").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, 0
    )
    running = rows.select(
        "*", *[F.bit_xor(f"x{i}").over(inside).alias(f"s{i}") for i in (1, 2)]
    )
    totals = rows.groupBy("conv_id", "part").agg(*[F.bit_xor(f"x{i}").alias(f"x{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = [
        F.coalesce(F.bit_xor(f"x{i}").over(earlier), F.lit(0).cast("long")).alias(f"b{i}")
        for i in (1, 2)
    ]
    joined = running.join(totals.select("conv_id", "part", *before), ["conv_id", "part"])
    joined = joined.join(sizes, "conv_id")
    key = [F.col(f"s{i}").bitwiseXOR(F.col(f"b{i}")) for i in (1, 2)]
    return joined.select(
        "conv_id",
        "depth",
        "words",
        (F.col("depth") == F.col("n_turns")).alias("is_last"),
        *[key[i - 1].alias(f"p{i}") for i in (1, 2)],
        *[key[i - 1].bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)],
    )


def _tree(prefixes: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """One row per node, numbered by `v`, with its parent's number `pv`."""
    zero = F.lit(0).cast("long")
    nodes = prefixes.groupBy("p1", "p2", "q1", "q2", "depth").agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("words").alias("words"),
    )
    root = sizes.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"))
    root = root.where("n_convs > 0").select(
        zero.alias("p1"),
        zero.alias("p2"),
        F.lit(None).cast("long").alias("q1"),
        F.lit(None).cast("long").alias("q2"),
        zero.alias("depth"),
        "conv_id",
        "n_convs",
        zero.alias("words"),
    )
    both = nodes.unionByName(root).withColumn("v", F.monotonically_increasing_id())
    both = scratch.table("nodes", both)
    parents = both.select(
        F.col("p1").alias("q1"),
        F.col("p2").alias("q2"),
        F.col("v").alias("pv"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    return scratch.table("tree", both.join(parents, ["q1", "q2"], "left").drop("q1", "q2"))


def _next_siblings(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """`v, pv, sibling`: children of a node follow each other by their smallest member."""
    children = tree.where("pv is not null").select("pv", "conv_id", "v")
    children = scratch.table("siblings", _ranged(children, "pv", "conv_id"))
    inside = Window.partitionBy("range_id").orderBy("at")
    # the first row of each range: as many as there are partitions
    firsts = children.groupBy("range_id").agg(F.min_by(F.struct("pv", "v"), "at").alias("first"))
    by_range = Window.orderBy("range_id")
    firsts = firsts.select("range_id", F.lead("first").over(by_range).alias("beyond"))
    following = F.coalesce(F.lead(F.struct("pv", "v")).over(inside), F.col("beyond"))
    joined = children.join(F.broadcast(firsts), "range_id")
    joined = joined.select("pv", "v", following.alias("following"))
    same = F.col("following.pv") == F.col("pv")
    return joined.select("pv", "v", F.when(same, F.col("following.v")).alias("sibling"))


def _tour(tree: DataFrame, scratch: Scratch) -> DataFrame:
    """`a, next` for all arcs: `2 * v` enters a node, `2 * v + 1` leaves it."""
    siblings = scratch.table("next", _next_siblings(tree, scratch))
    v, pv = F.col("v"), F.col("pv")
    leaving = siblings.select(
        (2 * v + 1).alias("a"), F.coalesce(2 * F.col("sibling"), 2 * pv + 1).alias("next")
    )
    root = tree.where("pv is null").select((2 * v + 1).alias("a"), F.lit(None).cast("long"))
    followed = siblings.where("sibling is not null").select(F.col("sibling").alias("v"), "pv")
    # a first child is no other's next sibling
    first = siblings.select("pv", "v").join(followed.select("v"), "v", "left_anti")
    entering = tree.select("v").join(first.select(F.col("pv").alias("v"), F.col("v").alias("child")), "v", "left")
    entering = entering.select(
        (2 * v).alias("a"), F.coalesce(2 * F.col("child"), 2 * v + 1).alias("next")
    )
    return leaving.union(root).union(entering)


def _walk(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Distances to the end of one short list."""
    rows = [row for frame in frames for row in frame.itertuples(index=False)]
    if not rows:
        return
    ahead = {n: (a, d) for a, n, d in rows}  # by the element that comes after
    at, total, found = ahead.pop(-1)[0], 0, []
    found.append((at, 0))
    while at in ahead:
        at, step = ahead[at]
        total += step
        found.append((at, total))
    yield pd.DataFrame(found, columns=["a", "rank"])


def list_rank(arcs: DataFrame, scratch: Scratch, picked: int = _PICKED, short: int = _CHUNK) -> DataFrame:
    """`a, rank`: the sum of `d` from each element of a linked list to its end.

    `arcs` has `a, next, d` with a null `next` at the end, and is stored. Elements
    picked by hash, one in `picked`, are stops. All others jump by doubling until they
    point at a stop, in a number of rounds that grows with the logarithm of the longest gap;
    the list of the stops is ranked likewise. A list of at most `short` elements is walked.
    """
    level, levels, now = 0, [], arcs
    while now.count() > short:

        def is_stop(x: Column, level: int = level) -> Column:
            return (F.pmod(F.xxhash64(x, F.lit(level)), F.lit(picked)) == 0) | end.eqNullSafe(x)

        end = F.lit(now.where("next is null").first()["a"])
        state = now.where("next is not null")
        done = []
        for round_ in range(200):
            name = f"rank-{level}-{round_}"
            open_ = ~is_stop(F.col("next"))
            state = scratch.table(name, state.select("a", "next", "d", open_.alias("open")))
            if state.where("open").isEmpty():
                break
            ahead = state.select(F.col("a").alias("next"), F.col("next").alias("to"), F.col("d").alias("more"))
            jumped = state.where("open").join(ahead, "next")
            jumped = jumped.select("a", F.col("to").alias("next"), (F.col("d") + F.col("more")).alias("d"))
            done.append(name)
            state = state.where("not open").select("a", "next", "d").union(jumped)
        else:
            raise RuntimeError("the list has no end")
        for old in done:
            scratch.drop(old)
        levels.append(state.select("a", "next", "d"))
        last = now.where("next is null").select("a", "next", "d")
        now = state.where(is_stop(F.col("a"))).select("a", "next", "d").union(last)
        now = scratch.table(f"stops-{level}", now)
        level += 1
    marked = now.select("a", F.coalesce("next", F.lit(-1).cast("long")), "d")
    ranks = marked.repartition(1).mapInPandas(_walk, "a long, rank long")
    for rows in reversed(levels):
        ranks = scratch.table(f"ranks-{level}", ranks)
        level += 1
        stops = ranks.select(F.col("a").alias("next"), F.col("rank").alias("more"))
        reached = rows.join(stops, "next").select("a", (F.col("d") + F.col("more")).alias("rank"))
        ranks = reached.union(ranks.where(F.col("rank") == 0))
    return ranks


def prefix_sums(df: DataFrame, values: list[str], total: int, chunk: int = _CHUNK) -> DataFrame:
    """`df` with each of `values` summed over all rows up to its own, by `pos` from 0.

    Chunks of `chunk` rows are summed apart, then their totals in the same way."""
    if total <= chunk:
        up_to = Window.orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.sum(c).over(up_to) for c in values})
    part = F.expr(f"pos div {chunk}")
    inside = Window.partitionBy("part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("part", part)
    totals = rows.groupBy("part").agg(*[F.sum(c).alias(c) for c in values])
    totals = totals.withColumnRenamed("part", "pos")
    totals = prefix_sums(totals, values, -(-total // chunk), chunk)
    before = totals.select(
        (F.col("pos") + 1).alias("part"), *[F.col(c).alias(f"before_{c}") for c in values]
    )
    running = rows.withColumns({c: F.sum(c).over(inside) for c in values})
    joined = running.join(before, "part", "left")
    summed = {c: F.col(c) + F.coalesce(f"before_{c}", F.lit(0)) for c in values}
    return joined.withColumns(summed).select(df.columns)


def _ends(prefixes: DataFrame, sizes: DataFrame) -> DataFrame:
    """`p1, p2, ends_sha256`: the ids of the conversations that end at a node, hashed as
    a stream of their decimal numbers, in pieces of at most 4096 ids."""
    zero = F.lit(0).cast("long")
    ends = prefixes.where("is_last").select("p1", "p2", "conv_id")
    ends = ends.union(sizes.where("n_turns = 0").select(zero, zero, "conv_id"))
    piece = F.call_function("shiftright", F.col("conv_id"), F.lit(12)).alias("piece")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string"))
    pieces = ends.groupBy("p1", "p2", piece).agg(F.array_join(ids, ",").alias("ids"))
    pieces = pieces.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "piece")

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            kinds = (pa.int64(), pa.int64(), pa.string())
            arrays = [pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["p1", "p2", "ends_sha256"])

        key, state, done = None, hashlib.sha256(), []
        for batch in batches:
            for p1, p2, text in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if key == (p1, p2):
                    state.update(b",")
                else:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = (p1, p2), hashlib.sha256()
                state.update(text.encode())
            if len(done) >= _CHUNK:
                yield rows(done)
                done = []
        if key is not None:
            yield rows([*done, (*key, state.hexdigest())])

    return pieces.mapInArrow(digest, "p1 long, p2 long, ends_sha256 string")


def conversation_trie(
    conversations: DataFrame,
    scratch: Scratch,
    every: int = 20,
    heads: int = 4,
    chunk: int = _CHUNK,
    picked: int = _PICKED,
) -> DataFrame:
    """`conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256` for every node of the trie of the rebuilt `conv_id, turn, role, text`.

    Turns are ordered by `turn`, null first; equal ones by a hash of role and text. A null
    role or text is empty; rows without `conv_id` belong to no conversation. Conversation c
    starts with the first h turns of conversation c - c % `every` (all if it has fewer, none
    if there is none), with h the crc32 of c's decimal digits modulo `heads`; its own turns
    after its first h follow. Rows that repeat a turn are two turns. An empty table has no
    node, not even a root. Other columns are ignored.

    Nodes are told apart by 128 bits of hashes. `chunk` and `picked` only cut the work.
    """
    numbered = scratch.table("numbered", _numbered_turns(conversations, scratch))
    sizes, turns = _rebuilt(numbered, every, heads, scratch)
    prefixes = scratch.table("prefixes", _prefixes(turns, sizes, chunk))
    for name in ("sorted", "numbered", "turns"):
        scratch.drop(name)
    tree = _tree(prefixes, sizes, scratch)
    tour = _tour(tree, scratch).withColumn("d", F.lit(1).cast("long"))
    tour = scratch.table("tour", tour)
    ranks = scratch.table("ranks", list_rank(tour, scratch, picked, chunk))

    total = ranks.count()
    children = tree.where("pv is not null").groupBy(F.col("pv").alias("v"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    nodes = tree.join(children, "v", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    nodes = scratch.table("counted", nodes)
    weights = nodes.select(
        (2 * F.col("v")).alias("a"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    values = ["leaves", "savings"]
    placed = ranks.join(weights, "a", "left").select(
        "a",
        (F.lit(total - 1) - F.col("rank")).alias("pos"),
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("leaf", "saved")],
    )
    placed = placed.withColumns({"leaves": F.col("leaf"), "savings": F.col("saved")})
    sums = prefix_sums(placed, values, total, chunk)
    leaves_it = F.col("a") % 2 == 1  # the sum up to the exit, less the sum before the entry

    def subtree(value: str, own: str) -> Column:
        return F.sum(F.when(leaves_it, F.col(value)).otherwise(F.col(own) - F.col(value)))

    below = sums.groupBy(F.expr("a div 2").alias("v")).agg(
        subtree("leaves", "leaf").alias("n_leaves"), subtree("savings", "saved").alias("saved_tokens")
    )
    ends = scratch.table("ends", _ends(prefixes, sizes))
    joined = nodes.join(below, "v").join(ends, ["p1", "p2"], "left")
    return joined.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
