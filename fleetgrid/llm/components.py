"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch

# Edges that one task settles at once: rounds over so few would only take time.
_SHORT = 50_000


def _with_least(edges: DataFrame) -> DataFrame:
    """Adds `m`, the smallest neighbour `v` of `u`. A hub's rows may be split by the join."""
    return edges.join(edges.groupBy("u").agg(F.min("v").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    least = _with_least(both).where(F.col("v") > F.col("u"))
    return least.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = _with_least(edges)  # u > v in every edge
    others = least.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), "m")
    return others.union(least.select("u", "m")).toDF("u", "v").distinct()


class Forest:
    """Components so far of the nodes that one task has met."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, u: int, v: int) -> bool:
        """Whether the two were apart."""
        u, v = self.root(u), self.root(v)
        self.parent[max(u, v)] = min(u, v)
        return u != v


def _settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`node, root` of a few edges, the root the smallest node."""
    forest = Forest()
    for batch in batches:
        for u, v in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            forest.join(u, v)
    found = [(x, top) for x in list(forest.parent) if (top := forest.root(x)) != x]
    if found:
        columns = [pa.array(x, pa.int64()) for x in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, ["node", "root"])


def components(
    edges: DataFrame, scratch: Scratch, name: str, short: int = _SHORT
) -> DataFrame:
    """`node, root` for every node of `edges` (`u`, `v`: longs) but the roots themselves.

    The root is the smallest node of the component. Large-star and small-star steps take
    turns; each round is written, and rounds grow with the logarithm of the size. At most
    `short` edges are settled by one task.
    """
    clean = edges.where("u <> v").select(F.greatest("u", "v"), F.least("u", "v")).toDF("u", "v")
    table, before = scratch.table(f"{name}-0", clean.distinct()), None
    if table.count() <= short:
        settled = table.coalesce(1).mapInArrow(_settled, "node long, root long")
        return scratch.table(f"{name}-settled", settled)
    for i in range(1, 200):
        state = table.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        now = tuple(state.first())
        if now == before:
            return table.select(F.col("u").alias("node"), F.col("v").alias("root"))
        table = scratch.table(f"{name}-{i}", _small_star(_large_star(table)))
        scratch.drop(f"{name}-{i - 1}")
        before = now
    raise RuntimeError("the components did not settle")
