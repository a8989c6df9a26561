"""Ranked lexical search: exact top documents by per-term blocks with geometric summaries.

Queries are taken in blocks of bounded size; for each block of them:

1. One pass over all texts keeps of each document its length and the frequencies of the
   block's terms, and a similarity key: the signs of random projections of its term vector,
   as a Gray code. Counts over all documents follow from it.
2. Documents are range-partitioned by that key and cut into shards. In a shard, each term's
   posting list stands in the order of the key, so neighbours are similar, and is cut into
   blocks. A block stores the coordinatewise maximum of its documents' impacts, over the
   terms that any query asks together with the list's term. Shards are stored.
3. A first search opens, of each query and shard, the block with the best bound only. The
   scores found give a score that the query's last result reaches at least.
4. A second search skips a block only if its bound, the sum of its summary by the query's
   weights, is below that score. Documents of opened blocks are scored exactly.

In a query's lists, heaviest term first, the bound for a list counts only its term and those
after it: documents with an earlier term stand in that one's list. All sums are
64-bit integers, so a bound is never below a score that it bounds.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, ship_package

# Bytes of terms as they are or in lower case, all others as a space.
_TERM_BYTES = bytes(
    ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalnum() else b if b > 0x7F else 0x20
    for b in range(256)
)


@dataclass(frozen=True)
class Limits:
    """Bounds of what a task holds; results never depend on them."""

    query_terms: int = 8192  # of all queries of a block, unless a single one has more
    cells: int = 1 << 23  # documents of a shard times terms of the block's queries
    block: int = 16  # documents of a posting list under one summary, at least


def block_sizes(together: list[np.ndarray], block: int) -> np.ndarray:
    """How many documents of each list stand under one summary: the more terms a summary
    has, the more, so that summaries take no more room than the lists themselves."""
    return np.array([max(block, len(x) // 8) for x in together], np.int64)


def terms(text: str | None) -> list[bytes]:
    """Maximal runs of letters, digits and characters beyond ASCII, A-Z in lower case."""
    return (text or "").encode("utf-8", "replace").translate(_TERM_BYTES).split()


@dataclass
class Queries:
    """A block of queries: each one's number and its distinct terms, as columns."""

    numbers: list[int]
    vocabulary: list[bytes]
    columns: list[np.ndarray]

    @staticmethod
    def of(rows: list[tuple[int, list[bytes]]]) -> Queries:
        vocabulary = sorted({t for _, words in rows for t in words})
        place = {t: i for i, t in enumerate(vocabulary)}
        columns = [np.array(sorted(place[t] for t in words), np.int64) for _, words in rows]
        return Queries([number for number, _ in rows], vocabulary, columns)

    def together(self) -> list[np.ndarray]:
        """For each term the terms of all queries that ask for it, itself included."""
        asked: list[list[np.ndarray]] = [[] for _ in self.vocabulary]
        for columns in self.columns:
            for t in columns.tolist():
                asked[t].append(columns)
        return [np.unique(np.concatenate(x)) for x in asked]


def _forward(docs: DataFrame, queries: Queries) -> DataFrame:
    """Of every document its number of terms, and the block's terms in it with their counts."""
    planes = [
        [1 if xxhash.xxh3_64_intdigest(t) >> i & 1 else -1 for i in range(24)]
        for t in queries.vocabulary
    ]
    shared = docs.sparkSession.sparkContext.broadcast((queries.vocabulary, planes))

    def forward(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, signs = shared.value
        place = {t: i for i, t in enumerate(vocabulary)}
        signs = np.array(signs, np.float64).reshape(len(vocabulary), 24)
        weights = 1 << np.arange(24, dtype=np.int64)
        for batch in batches:
            ns, found, counts, keys = [], [], [], []
            for text in batch.column(1).to_pylist():
                words = terms(text)
                own = Counter(words)
                hits = sorted((place[t], own[t]) for t in own.keys() & place.keys())
                at = np.array([x for x, _ in hits], np.int32)
                tf = np.array([x for _, x in hits], np.int64)
                code = int(weights[(tf / (tf + 2)) @ signs[at] > 0].sum())
                keys.append(_gray_rank(code))
                ns.append(len(words))
                found.append(at)
                counts.append(tf)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(ns, pa.int64()),
                    pa.array(keys, pa.int64()),
                    pa.array(found, pa.list_(pa.int32())),
                    pa.array(counts, pa.list_(pa.int64())),
                ],
                ["doc_id", "n", "key", "terms", "tf"],
            )

    schema = "doc_id long, n long, key long, terms array<int>, tf array<long>"
    return docs.select("doc_id", "text").mapInArrow(forward, schema)


def _gray_rank(code: int) -> int:
    """The place of a code word among Gray codes: neighbours differ in one bit."""
    for shift in (1, 2, 4, 8, 16):
        code ^= code >> shift
    return code


def _document_counts(forward: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term: an array of the vocabulary's size."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(total)
        columns = [pa.array(at, pa.int32()), pa.array(total[at], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["term", "n"])

    counts = forward.select("terms").mapInArrow(partial, "term int, n long")
    out = np.zeros(size, np.int64)
    for row in counts.groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def _shards(forward: DataFrame, queries: Queries, n_docs: int, length: int, limits: Limits) -> DataFrame:
    """One row per shard: documents, their impacts by term, and the blocks' summaries."""
    size = len(queries.vocabulary)
    most = max(1, limits.cells // size)
    shared = forward.sparkSession.sparkContext.broadcast(queries.together())
    block = limits.block
    names = ["docs", "starts", "at", "impacts", "summaries"]

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        together = shared.value
        sizes = block_sizes(together, block)
        dense = np.zeros((len(rows), size), np.int32)
        for i, (_, n, at, tf) in enumerate(rows):
            m = 50 + 50 * n * n_docs // length
            dense[i, at] = 1_000_000_000 * tf // (1000 * tf + 20 * m)
        term, doc = np.nonzero(dense.T)
        starts = np.searchsorted(term, np.arange(size + 1))
        summaries = []
        for t in np.flatnonzero(np.diff(starts)).tolist():
            listed = doc[starts[t] : starts[t + 1]]
            cells = dense[np.ix_(listed, together[t])]
            heads = np.arange(0, len(listed), sizes[t])
            summaries.append(np.maximum.reduceat(cells, heads, axis=0).ravel())
        packed = [starts.astype(np.int32), doc.astype(np.int32), dense[doc, term], np.concatenate(summaries)]
        columns = [pa.array([[x[0] for x in rows]], pa.list_(pa.int64()))]
        columns += [pa.array([x.tobytes()], pa.binary()) for x in packed]
        return pa.RecordBatch.from_arrays(columns, names)

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            at, tf = (x.to_numpy(zero_copy_only=False) for x in batch.columns[2:4])
            ids, ns = (batch.column(i).to_pylist() for i in range(2))
            for row in zip(ids, ns, at, tf, strict=True):
                rows.append(row)
                if len(rows) == most:
                    yield shard(rows)
                    rows = []
        if rows:
            yield shard(rows)

    ranged = forward.where(F.size("terms") > 0).repartitionByRange("key", "n", "doc_id")
    ranged = ranged.sortWithinPartitions("key", "n", "doc_id").select("doc_id", "n", "terms", "tf")
    schema = "docs array<long>, starts binary, at binary, impacts binary, summaries binary"
    return ranged.mapInArrow(build, schema)


class _Shard:
    """A stored shard, opened for search."""

    def __init__(self, row: dict, together: list[np.ndarray], block: int):
        self.docs, self.together = row["docs"], together
        self.sizes = block_sizes(together, block)
        self.starts = np.frombuffer(row["starts"], np.int32)
        self.at = np.frombuffer(row["at"], np.int32)
        impacts = np.frombuffer(row["impacts"], np.int32)
        lengths = np.diff(self.starts)
        self.dense = np.zeros((len(self.docs), len(lengths)), np.int32)
        self.dense[self.at, np.repeat(np.arange(len(lengths)), lengths)] = impacts
        self.highest = self.dense.max(axis=0).astype(np.int64)
        self.blocks = -(-lengths // self.sizes)
        self.summaries = np.frombuffer(row["summaries"], np.int32)
        widths = np.array([len(x) for x in together])
        self.offsets = np.concatenate([[0], np.cumsum(self.blocks * widths)])

    def lists(self, query: np.ndarray, weights: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """The query's lists, heaviest first: the term, a bound for this list and all after
        it, and the bounds of the list's blocks."""
        reach = weights[query] * self.highest[query]
        order = np.argsort(-reach, kind="stable")
        order = order[reach[order] > 0]
        beyond = np.cumsum(reach[order][::-1])[::-1]
        now = np.zeros(len(weights), np.int64)
        now[query] = weights[query]
        for i, t in enumerate(query[order].tolist()):
            cells = self.summaries[self.offsets[t] : self.offsets[t + 1]]
            yield t, int(beyond[i]), cells.reshape(self.blocks[t], -1) @ now[self.together[t]]
            now[t] = 0

    def block_docs(self, t: int, blocks: np.ndarray) -> np.ndarray:
        listed = self.at[self.starts[t] : self.starts[t + 1]]
        return listed[np.isin(np.arange(len(listed)) // self.sizes[t], blocks)]

    def scores(self, docs: np.ndarray, query: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return self.dense[np.ix_(docs, query)] @ weights[query]


class _Best:
    """The best results of a query so far, within one task."""

    def __init__(self, depth: int, least: int):
        self.depth, self.least = depth, least
        self.rows: list[tuple[int, bool, int]] = []  # (-score, whether the id is null, id)

    def add(self, docs: list, at: np.ndarray, scores: np.ndarray) -> None:
        for i in np.flatnonzero(scores >= self.least).tolist():
            doc = docs[at[i]]
            self.rows.append((-int(scores[i]), doc is None, doc or 0))
        if len(self.rows) > self.depth:
            self.rows = sorted(self.rows)[: self.depth]
            self.least = max(self.least, -self.rows[-1][0])


def _search(
    index: DataFrame, queries: Queries, weights: np.ndarray, least: dict[int, int], depth: int, block: int, first: bool
) -> DataFrame:
    """`query, doc_id, score`: each task's best for each query. With `first`, only each
    shard's best block is opened."""
    shared = index.sparkSession.sparkContext.broadcast((queries, queries.together(), weights, least))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, together, weights, least = shared.value
        best = [_Best(depth, max(1, least.get(number, 1))) for number in queries.numbers]
        for batch in batches:
            for row in batch.to_pylist():
                shard = _Shard(row, together, block)
                for query, own in zip(queries.columns, best, strict=True):
                    if first:
                        found = _best_block(shard, query, weights)
                    else:
                        found = _qualifying(shard, query, weights, own.least)
                    if len(found):
                        own.add(shard.docs, found, shard.scores(found, query, weights))
        rows = [
            (number, None if none else doc, -score)
            for number, own in zip(queries.numbers, best, strict=True)
            for score, none, doc in sorted(own.rows)
        ]
        columns = zip(*rows, strict=True) if rows else [[], [], []]
        arrays = [pa.array(list(x), pa.int64()) for x in columns]
        yield pa.RecordBatch.from_arrays(arrays, ["query", "doc_id", "score"])

    return index.mapInArrow(search, "query long, doc_id long, score long")


def _best_block(shard: _Shard, query: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The documents of the block with the highest bound."""
    best, found = 0, np.empty(0, np.int32)
    for t, beyond, bounds in shard.lists(query, weights):
        if beyond <= best:
            break
        if bounds.max() > best:
            best = int(bounds.max())
            found = shard.block_docs(t, bounds.argmax())
    return found


def _qualifying(shard: _Shard, query: np.ndarray, weights: np.ndarray, least: int) -> np.ndarray:
    """The documents of all blocks whose bound reaches `least`."""
    found = []
    for t, beyond, bounds in shard.lists(query, weights):
        if beyond < least:
            break
        opened = np.flatnonzero(bounds >= least)
        if len(opened):
            found.append(shard.block_docs(t, opened))
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int32)


def _ranked(found: DataFrame, depth: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= depth)


def _query_blocks(items: DataFrame, scratch: Scratch, limit: int) -> tuple[DataFrame, int]:
    """Items with their number and the block they belong to, and how many blocks there are."""

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [sorted(set(terms(x))) for x in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(words, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["item_id", "terms"])

    kind = items.schema["item_id"].dataType.simpleString()
    found = items.select("item_id", "text").mapInArrow(split, f"item_id {kind}, terms array<binary>")
    found = found.where(F.size("terms") > 0).withColumn("query", F.monotonically_increasing_id())
    found = scratch.table("items", found)
    running = Window.orderBy("query").rowsBetween(Window.unboundedPreceding, 0)
    sizes = found.select("query", F.sum(F.size("terms")).over(running).alias("up_to"))
    block = F.expr(f"up_to div {limit}").alias("block")
    placed = scratch.table("placed", found.join(sizes.select("query", block), "query"))
    return placed, (placed.agg(F.max("block")).first()[0] or 0) + 1


def search(
    docs: DataFrame, items: DataFrame, scratch: Scratch, depth: int = 50, limits: Limits = Limits()
) -> DataFrame:
    """`item_id, rank, doc_id, score`: the `depth` best documents for each row of `items`.

    Scores are as the contract of this operator states: a term weighs the floor of
    1000 * ln((2 N + 2) / (2 df + 1)), in doubles, and a document's length damps its
    frequencies; only scores above 0 count, equal ones by ascending `doc_id`, null last.

    Null and empty texts have no terms: such documents count nowhere, such items have no
    result. Every row is a document of its own, also if it repeats another one, and every
    row of `items` a query of its own. Other columns are ignored. The items are read in
    blocks, each of which scans all documents; `limits` bounds what is held for one.
    """
    ship_package(docs.sparkSession)
    placed, blocks = _query_blocks(items, scratch, limits.query_terms)
    results = []
    for number in range(blocks):
        rows = placed.where(F.col("block") == number).select("query", "terms").collect()
        if rows:
            queries = Queries.of([(r["query"], [bytes(t) for t in r["terms"]]) for r in rows])
            results.append(_search_block(docs, queries, scratch, f"{number}", depth, limits))
    if not results:
        kind = items.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    found = results[0]
    for other in results[1:]:
        found = found.union(other)
    return placed.select("query", "item_id").join(found, "query").select("item_id", "rank", "doc_id", "score")


def _search_block(
    docs: DataFrame, queries: Queries, scratch: Scratch, name: str, depth: int, limits: Limits
) -> DataFrame:
    forward = scratch.table(f"forward-{name}", _forward(docs, queries))
    totals = forward.where("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("terms"))
    n_docs, length = totals.first()
    held = _document_counts(forward, len(queries.vocabulary))
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()]
    weights = np.array(weights, np.int64)
    index = _shards(forward, queries, n_docs, length or 1, limits)
    index = scratch.table(f"index-{name}", index)
    scratch.drop(f"forward-{name}")
    first = _ranked(_search(index, queries, weights, {}, depth, limits.block, True), depth)
    least = first.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("score"))
    reached = {r["query"]: r["score"] for r in least.where(F.col("n") == depth).collect()}
    found = _search(index, queries, weights, reached, depth, limits.block, False)
    found = scratch.table(f"found-{name}", _ranked(found, depth))
    scratch.drop(f"index-{name}")
    return found.select("query", "rank", "doc_id", "score")
