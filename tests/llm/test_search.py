"""Ranked search, against scores of every document in plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from fleetgrid.llm import lexical_search
from fleetgrid.llm.lexical_search import Limits, search, terms
from tests.llm.cases import ascii_lower, documents, frame, prose, scratch

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text):
    return TERM.findall(ascii_lower(text))


def by_brute_force(docs, items, depth=50):
    own = [(i, words(t)) for i, t in docs]
    held = [(i, Counter(w), len(w)) for i, w in own if w]
    n_docs, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    found = []
    for item, text in items:
        scored = []
        for doc, c, n in held:
            m = 50 + 50 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(words(text)) & c.keys()
            )
            if score > 0:
                scored.append((-score, doc is None, doc))
        for rank, (score, _, doc) in enumerate(sorted(scored)[:depth], 1):
            found.append((item, rank, doc, -score))
    return sorted(found, key=str)


def cases():
    rng = random.Random(3)
    docs = documents() + [(3000 + i, prose(4000 + i, rng.randrange(1, 90))) for i in range(400)]
    docs += [(5000 + i, "Same text for all of these, really.") for i in range(80)]
    items = [(i, prose(4000 + 7 * i, 25)) for i in range(30)]
    items += [(100, None), (101, "--"), (102, "Same same TEXT"), (103, "no such words zzz"), (None, "É ß 😀 river"), (102, "river")]
    return docs, items


@pytest.mark.parametrize("limits, depth", [(Limits(), 50), (Limits(query_terms=60, cells=500, block=4), 3)])
def test_search(spark, limits, depth):
    docs, items = cases()
    table = frame(spark, [(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n long, terms string")
    asked = frame(spark, [(i, t, 5) for i, t in items], "item_id long, text string, rank int").repartition(3)
    got = search(table.repartition(5), asked, scratch(spark), depth, limits)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_brute_force(docs, items, depth)


def test_edges(spark):
    docs, items = frame(spark, [(1, "a b")]), frame(spark, [(1, "a")], "item_id long, text string")
    for some, asked in ((docs.where("false"), items), (docs, items.where("false"))):
        assert search(some, asked, scratch(spark)).collect() == []
    nothing = frame(spark, [(1, None), (2, ""), (3, " .,")])
    assert search(nothing, items, scratch(spark)).collect() == []
    repeated = frame(spark, [(1, "a b"), (1, "a b"), (2, "c")])
    got = search(repeated, items, scratch(spark)).collect()
    assert [(r["rank"], r["doc_id"]) for r in got] == [(1, 1), (2, 1)] and len({r["score"] for r in got}) == 1


def test_terms():
    for _, text in documents():
        assert [x.decode() for x in terms(text)] == words(text)


def test_bounds_hold_and_skip(spark):
    """No block's bound is below a score in it; blocks without a chance are skipped."""
    docs, items = cases()
    limits = Limits(block=4)
    queries = lexical_search.Queries.of([(i, sorted({x.encode() for x in words(t)})) for i, (_, t) in enumerate(items) if words(t)])
    forward = lexical_search._forward(frame(spark, docs), queries)
    place = scratch(spark)
    forward = place.table("forward", forward)
    index = lexical_search._shards(forward, queries, 400, 20_000, limits).collect()
    weights = np.arange(1, len(queries.vocabulary) + 1)
    together = queries.together()
    opened = there = 0
    for row in index:
        shard = lexical_search._Shard(row.asDict(), together, limits.block)
        for query in queries.columns:
            everything = np.arange(len(shard.docs))
            scores = shard.scores(everything, query, weights)
            earlier = np.zeros(len(everything), bool)
            for t, beyond, bounds in shard.lists(query, weights):
                for b, bound in enumerate(bounds):
                    at = shard.block_docs(t, b)
                    fresh = at[~earlier[at]]
                    assert (scores[fresh] <= bound).all() and bound <= beyond
                earlier[shard.dense[:, t] > 0] = True
            least = int(np.sort(scores)[-3:][0]) or 1
            found = lexical_search._qualifying(shard, query, weights, least)
            assert set(np.flatnonzero(scores >= least)) <= set(found.tolist())
            opened, there = opened + len(found), there + int((scores > 0).sum())
    assert 0 < opened < there / 2
