"""The trie of conversations, against plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fleetgrid.llm.prefix_trie import conversation_trie, list_rank, prefix_sums
from tests.llm.cases import frame, scratch

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [x[2:] for x in sorted(own)] for c, own in turns.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = turns.get(base, [])[:h] + own[h:]
    return out


def by_brute_force(rows):
    members = defaultdict(list)
    convs = rebuilt(rows)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        n_words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves = sum(below[x][0] for x in children[node]) if children[node] else 1
        saved = (len(members[node]) - 1) * n_words + sum(below[x][1] for x in children[node])
        below[node] = (leaves, saved)
    found = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        found.append((
            min(own), len(node), min(members[node[:-1]]) if node else None, len(own),
            len(children[node]), *below[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


def conversations():
    rng = random.Random(8)
    rows = []
    for c in [*range(-30, 130), 5000, 10**12]:
        for turn in range(rng.randrange(1, 7)):
            text = rng.choice(["Hello there, you", "yes", "no no", "", None, "x" * 50_000, " \t", "é ß"])
            rows.append((c, turn if turn else rng.choice([0, None]), rng.choice(["user", None]), text))
    rows += [(2 * i + 1001, 3, "user", "the same for all") for i in range(60)]
    rows += [(140, i, "a", f"turn {i}") for i in range(300)]
    rows += [(c, i, "a", f"turn {i}") for c in (141, 142, 143, 144) for i in range(290)]
    rows += [(None, 1, "a", "of no conversation")] * 3
    return rows + [r for r in rows if r[0] is not None][-3:]  # turns that repeat


@pytest.mark.parametrize("chunk, picked", [(4096, 64), (40, 4)])
def test_trie(spark, chunk, picked):
    rows = conversations()
    table = frame(spark, [(*r, 1, 2) for r in rows], f"{SCHEMA}, depth long, at long").repartition(7)
    got = conversation_trie(table, scratch(spark), chunk=chunk, picked=picked)
    assert sorted((tuple(r) for r in got.collect()), key=str) == by_brute_force(rows)


def test_edges(spark):
    assert conversation_trie(frame(spark, [], SCHEMA), scratch(spark)).collect() == []
    only = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(only, 1, "user", "dropped, as its first turns are another's")]
    got = [tuple(r) for r in conversation_trie(frame(spark, rows, SCHEMA), scratch(spark)).collect()]
    assert got == by_brute_force(rows) and got[0][1] == 0 and len(got) == 1


def test_turns_that_tie_have_one_order(spark):
    rows = [(20, 1, "user", f"text {i}") for i in range(9)] + [(40, 2, "a", "b")]
    table = frame(spark, rows, SCHEMA)
    got = [sorted(map(str, conversation_trie(x, scratch(spark)).collect()))
           for x in (table, table.orderBy(F.desc("text")))]
    assert got[0] == got[1]


def test_list_rank(spark):
    rng, n = random.Random(1), 700
    order = rng.sample(range(10**6), n)
    steps = [rng.randrange(1, 9) for _ in order]
    rows = [(a, b, d) for a, b, d in zip(order, [*order[1:], None], steps)]
    rng.shuffle(rows)
    place = scratch(spark)
    arcs = place.table("arcs", frame(spark, rows, "a long, next long, d long"))
    got = {r["a"]: r["rank"] for r in list_rank(arcs, place, picked=5, short=10).collect()}
    assert got == {a: sum(steps[i:-1]) for i, a in enumerate(order)}


def test_prefix_sums(spark):
    values = [(i, i * i - 30, 1) for i in range(500)]
    got = prefix_sums(frame(spark, values, "pos long, x long, y long"), ["x", "y"], 500, 6)
    want, total = [], 0
    for i, x, _ in values:
        total += x
        want.append((i, total, i + 1))
    assert sorted(tuple(r) for r in got.collect()) == want
