"""Near duplicates by an inverted join over the coordinates of MinHash signatures.

1. Each document becomes its set of shingles and a signature of `coordinates` minima.
   Equal sets are one set from here on.
2. Sets are posted under each (coordinate, value). Lists are counted exactly. A pair to
   be retained collides in at least `matches` coordinates; so a set with s coordinates that
   any other set shares is of interest only for s >= `matches`, and the s - `matches` + 1
   shortest of its lists must meet the pair. Its longer lists are skipped.
3. Inside a list, collisions are counted over whole signatures; pairs above the threshold
   are retained, as many as connect them. They chain sets to families.
4. In a family, retained pairs are confirmed on the full sets. Links that join two
   components so far leave the task; their components are the result.

A long list is cut into chunks, and a large family into parts. Parts are compared in
themselves first, then the smallest members of their components, and only families that are
still not connected are compared part by part.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, row_key, same_key, ship_package
from fleetgrid.llm.components import Forest, components
from fleetgrid.llm.shingles import shingle_set


@dataclass(frozen=True)
class Signatures:
    """Two sets with a similarity of at least 0.85 collide in fewer than 18 of 40
    coordinates with a chance of 7 in 10,000,000,000: such a pair would be lost."""

    coordinates: int = 40
    matches: int = 18


@functools.cache
def _constants(name: str, n: int) -> np.ndarray:
    return np.array([[xxhash.xxh3_64_intdigest(f"{name}{i}") | 1] for i in range(n)], np.uint64)


def minima(shingles: np.ndarray, coordinates: int) -> np.ndarray:
    """The smallest value of each of the hash functions over a set of hashed shingles."""
    flips, factors = _constants("flip", coordinates), _constants("factor", coordinates)
    least = np.full(coordinates, np.iinfo(np.int64).max)
    for i in range(0, len(shingles), 1024):
        values = shingles[None, i : i + 1024] ^ flips
        values *= factors
        np.minimum(least, values.view(np.int64).min(axis=1), out=least)
    return least.view(np.uint64)


def _tokens(least: np.ndarray) -> np.ndarray:
    """One number for each (coordinate, value)."""
    bits = np.uint64(max(1, (len(least) - 1).bit_length()))
    return ((least >> bits << bits) | np.arange(len(least), dtype=np.uint64)).view(np.int64)


def _marks(least: np.ndarray) -> bytes:
    """16 bits of each value: equal values have equal marks."""
    return (least >> np.uint64(8)).astype(np.uint16).tobytes()


def _profile(docs: DataFrame, size: int, coordinates: int) -> DataFrame:
    """Of each document its set's size and identity; signatures once for a set and task."""

    def profile(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            ns, identities, tokens, marks = [], [], [], []
            for text in batch.column(2).to_pylist():
                shingles = shingle_set(text, size)
                identity = xxhash.xxh3_128_digest(shingles.tobytes())
                new = len(shingles) and identity not in seen
                if new:
                    seen.add(identity)
                    least = minima(shingles, coordinates)
                ns.append(len(shingles))
                identities.append(identity)
                tokens.append(_tokens(least) if new else None)
                marks.append(_marks(least) if new else None)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            values = zip((ns, identities, tokens, marks), kinds, strict=True)
            columns = [batch.column(0), batch.column(1), *(pa.array(x, kind) for x, kind in values)]
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["key_id", "key_text", "n", "identity", "tokens", "marks"]
    schema = "key_id long, key_text long, n long, identity binary, tokens array<long>, marks binary"
    return docs.select(*row_key(), "text").mapInArrow(profile, schema)


def _sets(profile: DataFrame) -> DataFrame:
    """Distinct sets, numbered; `key_id, key_text` name one of the documents."""
    first = F.min(F.struct("key_id", "key_text")).alias("first")
    signed = F.any_value(F.when(F.col("tokens").isNotNull(), F.struct("tokens", "marks")), True)
    sets = profile.where("n > 0").groupBy("identity").agg(
        F.max("n").alias("n"), F.min("key_id").alias("least"), first, signed.alias("signed")
    )
    return sets.select(
        F.monotonically_increasing_id().alias("set_id"), "identity", "n", "least", "first.*", "signed.*"
    )


def _posted(sets: DataFrame, matches: int) -> DataFrame:
    """`set_id, prefix`: sets with enough shared coordinates, and their shortest lists."""
    postings = sets.select("set_id", F.explode("tokens").alias("token"))
    lengths = postings.groupBy("token").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    shared = postings.join(lengths, "token").groupBy("set_id")
    lists = shared.agg(F.sort_array(F.collect_list(F.struct("length", "token"))).alias("lists"))
    lists = lists.where(F.size("lists") >= matches)
    return lists.select("set_id", F.slice("lists", 1, F.size("lists") - matches + 1).alias("prefix"))


def _spanning(
    marks: np.ndarray, n: np.ndarray, matches: int, percent: int
) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of rows above the threshold, enough to connect all of them, and each row's
    component. Rows are sorted by `n`."""
    label = np.arange(len(n))
    pairs = []
    for i in range(1, len(n)):
        low = int(np.searchsorted(100 * n[:i], percent * n[i]))
        hits = low + np.flatnonzero((marks[low:i] == marks[i]).sum(axis=1) >= matches)
        for j in hits:
            if label[j] != label[i]:
                pairs.append((int(j), i))
                label[label == max(label[i], label[j])] = min(label[i], label[j])
    return pairs, label


def _retained(posted: DataFrame, matches: int, percent: int, chunk: int) -> DataFrame:
    """`u, v`: retained pairs, enough to connect them. The components in the chunks of a list
    of more than `chunk` sets are taken as connected, by a node for the list itself."""
    entry = F.explode("prefix").alias("entry")
    rows = posted.select("set_id", "n", "marks", entry)
    chunks = F.ceil(F.col("entry.length") / chunk).cast("long")
    rows = rows.select(
        F.col("entry.token").alias("token"),
        F.when(chunks > 1, F.pmod(F.xxhash64("set_id"), chunks)).otherwise(-1).alias("chunk"),
        "n",
        "set_id",
        "marks",
    )
    rows = rows.repartition("token", "chunk").sortWithinPartitions("token", "chunk", "n", "set_id")

    def edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest, forest = None, Forest()  # what earlier lists have connected is not said again
        for batch in batches:
            new = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            width = len(batch.column(4)[0].as_py()) if len(batch) else 0
            new.append(np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint16))
            new[4] = new[4].reshape(-1, width // 2)
            if rest is not None:
                new = [np.concatenate(x) for x in zip(rest, new, strict=True)]
            starts = np.flatnonzero((np.diff(new[0]) != 0) | (np.diff(new[1]) != 0)) + 1
            cut = int(starts[-1]) if len(starts) else 0
            yield from found([x[:cut] for x in new], starts[:-1], forest)
            rest = [x[cut:] for x in new]
        if rest is not None:
            yield from found(rest, np.empty(0, np.int64), forest)

    def found(
        rows: list[np.ndarray], starts: np.ndarray, forest: Forest
    ) -> Iterator[pa.RecordBatch]:
        token, part, n, ids, marks = rows
        us, vs = [], []
        bounds = np.concatenate([[0], starts, [len(token)]])
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
            if b - a < 2 and (b == a or part[a] < 0):
                continue
            pairs, label = _spanning(marks[a:b], n[a:b], matches, percent)
            own = ids[a:b].tolist()
            links = [(own[i], own[j]) for i, j in pairs]
            if part[a] >= 0:
                of_list = int(token[a]) | -(1 << 63)  # negative: no set
                links += [(of_list, own[i]) for i in np.unique(label)]
            for u, v in links:
                if forest.join(u, v):
                    us.append(u)
                    vs.append(v)
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (us, vs)], ["u", "v"])

    return rows.mapInArrow(edges, "u long, v long").distinct()


@dataclass
class Group:
    """Sets that are compared in one go, as rows in order of `side`, then `n`."""

    ids: np.ndarray
    n: np.ndarray
    side: np.ndarray
    label: np.ndarray
    marks: np.ndarray
    sets: list[np.ndarray]

    @staticmethod
    def of(rows: list[tuple], size: int) -> Group:
        own = sorted({x[0]: x for x in rows}.values(), key=lambda x: (x[5], x[1], x[0]))
        ids, n, marks, texts, labels, sides = zip(*own, strict=True)
        label = np.unique(np.array(labels), return_inverse=True)[1]
        sets = [shingle_set(x, size) for x in texts]
        marks = np.frombuffer(b"".join(marks), np.uint16).reshape(len(own), -1)
        return Group(np.array(ids), np.array(n), np.array(sides), label, marks, sets)


Compare = Callable[[Group], Iterable[tuple[int, int]]]


def confirmed(group: Group, rule: Signatures, percent: int) -> Iterator[tuple[int, int]]:
    """Links between rows of different `label` (and of different `side`, where that is not
    negative), enough to connect all that are linked."""
    n, side, label, marks = group.n, group.side, group.label, group.marks
    vocabulary, codes = np.unique(np.concatenate(group.sets), return_inverse=True)
    ends = np.cumsum([len(x) for x in group.sets])
    starts = ends - [len(x) for x in group.sets]
    has = np.zeros(len(vocabulary), bool)
    for i in range(1, len(n)):
        low, high = np.minimum(n[:i], n[i]), np.maximum(n[:i], n[i])
        hits = (label[:i] != label[i]) & (100 * low >= percent * high)
        hits = np.flatnonzero(hits & ((side[:i] < 0) | (side[:i] != side[i])))
        hits = hits[(marks[hits] == marks[i]).sum(axis=1) >= rule.matches]
        if not len(hits):
            continue
        has[codes[starts[i] : ends[i]]] = True
        for j in hits:
            if label[j] == label[i]:
                continue
            both = np.count_nonzero(has[codes[starts[j] : ends[j]]])
            if 100 * both >= percent * (n[j] + n[i] - both):
                yield int(j), i
                label[label == label[i]] = label[j]
        has[codes[starts[i] : ends[i]]] = False


class Families:
    """Families of sets that may be linked, and the links that connect their components.

    `compare` gets a group and gives links between its rows of different `label`, and of
    different `side` where that is not negative: enough to connect all that are linked.
    """

    def __init__(self, members: DataFrame, scratch: Scratch, size: int, compare: Compare):
        self.members, self.scratch, self.size, self.compare = members, scratch, size, compare
        self.tables: list[DataFrame] = []

    def _compare(self, rows: DataFrame, *keys: str) -> None:
        size, compare, width = self.size, self.compare, len(keys)

        def links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            key, own = None, []
            for batch in batches:
                for row in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                    if row[:width] != key:
                        yield from found(own)
                        key, own = row[:width], []
                    own.append(row[width:])
            yield from found(own)

        def found(own: list[tuple]) -> Iterator[pa.RecordBatch]:
            if len(own) < 2:
                return
            group = Group.of(own, size)
            pairs = np.array(list(compare(group)), np.int64).reshape(-1, 2)
            if len(pairs):
                columns = [pa.array(group.ids[pairs[:, i]]) for i in range(2)]
                yield pa.RecordBatch.from_arrays(columns, ["u", "v"])

        columns = ["set_id", "n", "marks", "text", "label", "side"]
        sorted_ = rows.select(*keys, *columns).repartition(*keys).sortWithinPartitions(*keys)
        pairs = sorted_.mapInArrow(links, "u long, v long")
        self.tables.append(self.scratch.table(f"links-{len(self.tables)}", pairs))

    def _all(self) -> DataFrame:
        return functools.reduce(DataFrame.union, self.tables)

    def _open(self) -> DataFrame:
        """Members of the families of several parts that are not connected yet, each with
        its component so far as `label`, and how many there are in its family as `left`."""
        roots = components(self._all(), self.scratch, f"parts-{len(self.tables)}")
        many = self.members.where("parts > 1").join(
            roots.withColumnRenamed("node", "set_id"), "set_id", "left"
        )
        many = many.withColumn("label", F.coalesce("root", "set_id")).drop("root")
        left = many.where("label = set_id").groupBy("family").agg(F.count(F.lit(1)).alias("left"))
        many = many.join(left.where("left > 1"), "family")
        return self.scratch.table(f"open-{len(self.tables)}", many)

    def links(self, part_sets: int) -> DataFrame:
        """`u, v`: parts are compared in themselves; then the smallest members of the
        components, as long as that halves their number; then what is left, part by part."""
        alone = {"label": F.col("set_id"), "side": F.lit(-1)}
        self._compare(self.members.withColumns(alone), "family", "part")
        if self.members.where("parts > 1").isEmpty():
            return self._all()
        before = None
        while True:
            rows = self._open()
            heads = rows.where("label = set_id").withColumn("side", F.lit(-1))
            now = heads.count()
            if not now:
                return self._all()
            if before is not None and 2 * now > before:
                break
            before = now
            turn = F.lit(len(self.tables))  # other parts each time
            group = F.pmod(F.xxhash64("set_id", turn), F.ceil(F.col("left") / part_sets))
            self._compare(heads.withColumn("group", group), "family", "group")
        other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
        pairs = rows.select("*", other).where("other <> part").select(
            "*",
            F.least("part", "other").alias("a"),
            F.greatest("part", "other").alias("b"),
            F.col("part").alias("side"),
        )
        self._compare(pairs, "family", "a", "b")
        return self._all()


def _members(
    docs: DataFrame, sets: DataFrame, families: DataFrame, part_sets: int, part_shingles: int
) -> DataFrame:
    """Sets of families of several, with a text and the number of their part."""
    placed = families.join(sets.select("set_id", "n", "marks", "key_id", "key_text"), "set_id")
    totals = placed.groupBy("family").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("total"))
    by_count, by_size = F.col("k") / part_sets, F.col("total") / part_shingles
    parts = F.ceil(F.greatest(by_count, by_size)).cast("int").alias("parts")
    placed = placed.join(totals.where("k > 1").select("family", parts), "family")
    part: Column = F.pmod(F.xxhash64("set_id"), F.col("parts")).cast("int")
    wanted = placed.withColumn("part", part)
    texts = docs.select(*row_key(), "text")
    joined = texts.join(wanted.hint("merge"), same_key(texts, wanted))
    return joined.select("family", "parts", "part", "set_id", "n", "marks", "text")


def similar_components(
    docs: DataFrame,
    scratch: Scratch,
    size: int,
    percent: int,
    rule: Signatures,
    compare: Compare,
    chunk: int,
    part_sets: int,
    part_shingles: int,
) -> DataFrame:
    """`key_id, key_text, n, component` for every row of `doc_id, text`: its key, the size of
    its set and the smallest id that links reach, as `compare` confirms them."""
    ship_package(docs.sparkSession)
    profile = scratch.table("profile", _profile(docs, size, rule.coordinates))
    sets = scratch.table("sets", _sets(profile))
    posted = _posted(sets, rule.matches).join(sets.select("set_id", "n", "marks"), "set_id")
    edges = _retained(scratch.table("posted", posted), rule.matches, percent, chunk)
    chained = components(edges, scratch, "families")
    chained = chained.union(chained.select("root", "root").distinct()).toDF("set_id", "family")
    members = scratch.table("members", _members(docs, sets, chained, part_sets, part_shingles))
    scratch.drop("posted")
    links = Families(members, scratch, size, compare).links(part_sets)
    linked = components(links, scratch, "components").withColumnRenamed("node", "set_id")
    scratch.drop("members")
    roots = sets.select("set_id", "identity", "least").join(linked, "set_id", "left")
    roots = roots.select("identity", "least", F.coalesce("root", "set_id").alias("root"))
    smallest = roots.groupBy("root").agg(F.min("least").alias("component"))
    of_set = scratch.table("of-set", roots.join(smallest, "root").select("identity", "component"))
    joined = profile.select("key_id", "key_text", "n", "identity").join(of_set, "identity", "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("key_id"))
    return joined.select("key_id", "key_text", "n", component.alias("component"))


def minhash_components(
    docs: DataFrame,
    scratch: Scratch,
    size: int = 5,
    percent: int = 85,
    rule: Signatures = Signatures(),
    chunk: int = 512,
    part_sets: int = 512,
    part_shingles: int = 1_000_000,
) -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` for every row of `doc_id, text`.

    Two documents link when `100 * intersection >= percent * union` of their sets of
    shingles, confirmed on the full sets; the component is the smallest `doc_id` that links
    reach, and `kept` holds where that is the document's own. A link may only be lost as
    `rule` states. Documents without words (or a null text) have an empty set and no links.
    Equal sets link. A null id is a document's id, but no component's unless it is
    alone. Rows that repeat id and text are one document, and each has its row. Other
    columns are ignored. `chunk`, `part_sets` and `part_shingles` bound what a task compares,
    never what is compared.
    """

    def compare(group: Group) -> Iterator[tuple[int, int]]:
        return confirmed(group, rule, percent)

    found = similar_components(
        docs, scratch, size, percent, rule, compare, chunk, part_sets, part_shingles
    )
    return found.select(
        F.col("key_id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("key_id").eqNullSafe(F.col("component")).alias("kept"),
    )
