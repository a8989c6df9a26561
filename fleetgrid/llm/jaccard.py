"""Documents whose shingle sets overlap: exact links and their components.

1. Documents with equal sets are one set. Sets that may be similar are partitioned into
   groups: a pair of similar sets collides in many coordinates of their MinHash
   signatures, so sets are chained only where enough coordinates collide (`minhash`). Links
   lie inside groups.
2. Inside a group, similar documents form blocks. A block keeps the union of its
   tokens, as a row of a token-group matrix. A document's overlap with the union bounds its
   overlap with each member, so only blocks within the bound are opened and compared
   exactly. Only links that join two components so far leave the task.
3. The links' components are the result.

A group is never gathered whole when it is large: it is cut into parts of bounded size,
which are compared in themselves first, and pair by pair only where the group is not
connected by then.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch
from fleetgrid.llm.minhash import Group, Signatures, similar_components

_BLOCK = 32

# Two sets with a similarity of at least 0.8 collide in fewer than 13 of 40 coordinates
# with a chance of 1 in 100,000,000,000: such a pair would not be compared.
SIGNATURES = Signatures(coordinates=40, matches=13)


def required(n: int, percent: int) -> int:
    """The least overlap with any similar set."""
    return -(-n * percent // 100)


class _Forest:
    """Components so far of some documents of one task."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def link(
    sets: list[np.ndarray], left: int, percent: int, known: np.ndarray | None = None
) -> Iterator[tuple[int, int]]:
    """Links among `sets`, enough of them to connect all that are similar.

    With `left`, only links between the first `left` sets and the others count. Sets with
    the same number in `known` are connected already.
    """
    if len(sets) < 2:
        return
    sizes = np.array([len(x) for x in sets])
    # similar sets stand together: the smallest shingle is the same with that likelihood
    order = sorted(range(len(sets)), key=lambda i: (i < left, sets[i][0], sizes[i]))
    order = np.array(order)
    vocabulary, codes = np.unique(np.concatenate(sets), return_inverse=True)
    codes = np.split(codes, np.cumsum(sizes)[:-1])
    side = np.arange(len(sets)) < left
    cuts = [*range(0, int((~side).sum()), _BLOCK)]
    cuts += [*range(int((~side).sum()), len(sets), _BLOCK), len(sets)]
    blocks = [order[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    unions = [np.unique(np.concatenate([codes[i] for i in block])) for block in blocks]
    # the token-group matrix, by token: the blocks whose union has it
    counts = np.bincount(np.concatenate(unions), minlength=len(vocabulary))
    starts = np.concatenate([[0], np.cumsum(counts)])
    block_of = np.repeat(np.arange(len(blocks)), [len(x) for x in unions])
    groups = block_of[np.argsort(np.concatenate(unions), kind="stable")]
    members = [np.concatenate([codes[i] for i in block]) for block in blocks]
    offsets = [np.cumsum([0, *sizes[block][:-1]]) for block in blocks]
    forest, has = _Forest(len(sets)), np.zeros(len(vocabulary), bool)
    if known is not None:
        _, firsts, numbers = np.unique(known, return_index=True, return_inverse=True)
        for i, first in enumerate(firsts[numbers]):
            forest.join(i, int(first))
    for number, block in enumerate(blocks):
        for q in block:
            own = codes[q]
            spans = counts[own]
            at = np.repeat(starts[own] - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
            overlap = np.bincount(groups[at], minlength=len(blocks))
            qualifying = np.flatnonzero(overlap >= required(len(own), percent))
            has[own] = True
            for g in qualifying[qualifying <= number]:
                others = blocks[g]
                fits = (100 * np.minimum(sizes[others], sizes[q])) >= percent * np.maximum(
                    sizes[others], sizes[q]
                )
                if left:
                    fits &= side[others] != side[q]
                root = forest.root(q)
                fits &= np.array([forest.root(i) != root for i in others])
                if not fits.any():
                    continue
                both = np.add.reduceat(has[members[g]].astype(np.int64), offsets[g])
                union = sizes[others] + sizes[q] - both
                for i in others[fits & (100 * both >= percent * union)]:
                    if forest.join(q, i):
                        yield int(q), int(i)
            has[own] = False


def jaccard_components(
    docs: DataFrame,
    scratch: Scratch,
    size: int = 5,
    percent: int = 80,
    part_shingles: int = 1_000_000,
    part_sets: int = 512,
    rule: Signatures = SIGNATURES,
) -> DataFrame:
    """`doc_id, key_text, n_shingles, component_id` for every row of `doc_id, text`.

    Two documents link when `100 * intersection >= percent * union` of their sets of
    shingles; the component is the smallest `doc_id` that links reach. Documents without
    words (or a null text) have an empty set and no links. Equal sets link. A null id is
    a document's id, but no component's unless it is alone. Rows that repeat id and text
    are one document, and each has its row. `key_text` is the hash of the text. Other
    columns are ignored. `part_shingles` and `part_sets` bound what a task compares.
    """

    def compare(group: Group) -> Iterator[tuple[int, int]]:
        left = int((group.side == group.side[0]).sum()) if group.side[0] >= 0 else 0
        return link(group.sets, left, percent, group.label)

    found = similar_components(
        docs, scratch, size, percent, rule, compare, 512, part_sets, part_shingles
    )
    return found.select(
        F.col("key_id").alias("doc_id"),
        "key_text",
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
    )
