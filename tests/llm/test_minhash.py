"""Near duplicates by signatures, against all pairs in plain Python."""

import itertools

import numpy as np
import pytest
from fleetgrid.llm import minhash
from fleetgrid.llm.minhash import Signatures, minhash_components, minima
from fleetgrid.llm.shingles import shingle_set
from tests.llm.cases import documents, frame, prose, scratch
from tests.llm.test_links import edited, near_copies, roots, shingles


def by_brute_force(rows, percent=85):
    sets = {i: shingles(t) for i, t in rows}
    pairs = [
        (a, b)
        for a, b in itertools.combinations(sets, 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {i: (len(sets[i]), root) for i, root in roots(sets, pairs).items()}


def loose_copies():
    """Chains of edits: many are linked only through others, and some to none."""
    rows, text = [], prose(300, 200)
    for i in range(40):
        rows.append((7000 + i, text))
        text = edited(text, 0.012 * (i % 3), 900 + i)
    return rows


@pytest.mark.parametrize("chunk, part_sets", [(512, 512), (4, 7)])
def test_components(spark, chunk, part_sets):
    rows = [r for r in documents() if r[0] is not None] + near_copies() + loose_copies()
    docs = frame(spark, [(i, t, 1, 2, 3) for i, t in rows],
                 "doc_id long, text string, n long, set_id long, label long")
    got = minhash_components(docs, scratch(spark), chunk=chunk, part_sets=part_sets).collect()
    want = by_brute_force(rows)
    assert len(got) == len(rows)
    for row in got:
        assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]], row["doc_id"]
        assert row["kept"] == (row["doc_id"] == row["component_id"])
    assert len({r["component_id"] for r in got}) < len(set(rows)) - 100


def test_edges(spark):
    rows = [(None, "a b c d e f"), (None, "only here it is all"), (4, "A B C D E F"), (5, ""), (6, None)]
    got = {tuple(r) for r in minhash_components(frame(spark, rows), scratch(spark)).collect()}
    assert got == {(None, 2, 4, False), (4, 2, 4, True), (None, 1, None, True), (5, 0, 5, True), (6, 0, 6, True)}
    assert minhash_components(frame(spark, []), scratch(spark)).count() == 0


def test_families_stay_small(spark):
    """Texts that share a passage, and texts that are alike by half, are not one family."""
    passage = prose(400, 60)
    rows = [(i, f"{prose(1000 + i, 140)} {passage}") for i in range(300)]
    half = prose(401, 100)
    rows += [(1000 + i, f"{half} {prose(2000 + i, 130)}") for i in range(100)]
    place = scratch(spark)
    docs = frame(spark, rows)
    sets = minhash._sets(minhash._profile(docs, 5, 40))
    sets = place.table("sets", sets)
    posted = minhash._posted(sets, 18)
    assert posted.count() <= 100 + 5  # none shares enough coordinates for a passage alone
    got = minhash_components(docs, scratch(spark))
    assert got.where("kept").count() == len(rows)


def test_coordinates_collide_as_often_as_sets_overlap():
    rng = np.random.default_rng(5)
    for share in (0.3, 0.85, 0.95):
        hits = []
        for _ in range(60):
            both = rng.integers(0, 1 << 63, 400, np.uint64)
            n = int(400 * (1 - share) / (1 + share))
            a = np.concatenate([both[n:], rng.integers(0, 1 << 63, n, np.uint64)])
            hits.append(np.mean(minima(a, 40) == minima(both, 40)))
        exact = (400 - n) / (400 + n)
        assert abs(np.mean(hits) - exact) < 0.04


def test_small_sets_collide_enough():
    rule = Signatures()
    for i in range(300):
        words = [f"w{i}x{j}" for j in range(12)]
        a, b = shingle_set(" ".join(words)), shingle_set(" ".join(words[:-1]))
        assert 100 * len(b) >= 85 * len(a)
        assert (minima(a, rule.coordinates) == minima(b, rule.coordinates)).sum() >= rule.matches
