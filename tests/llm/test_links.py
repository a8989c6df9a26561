"""Near duplicates, components and the whole pipeline, against plain Python."""

import itertools
import random
import re

import corpus_pipeline
import pytest
from fleetgrid.llm import minhash
from fleetgrid.llm.components import components
from fleetgrid.llm.jaccard import jaccard_components, link
from fleetgrid.llm.queries import packed
from fleetgrid.llm.shingles import shingle_set
from tests.llm.cases import ascii_lower, documents, frame, prose, scratch
from tests.llm.test_texts import base_counts, contamination, kept_lines


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text))
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if words else set()


def roots(nodes, edges):
    parent = {x: x for x in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {x: find(x) for x in nodes}


def similar(a, b):
    return bool(a) and 100 * len(a & b) >= 80 * len(a | b)


def by_brute_force(rows):
    sets = {i: shingles(t) for i, t in rows}
    pairs = [(a, b) for a, b in itertools.combinations(sets, 2) if similar(sets[a], sets[b])]
    return {i: (len(sets[i]), root) for i, root in roots(sets, pairs).items()}


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"new{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())


def near_copies():
    """A large group of near copies around one text, some of them linked by others only."""
    base = prose(50, 150)
    rows = [(1000 + i, edited(base, 0.005 * (i % 8), i)) for i in range(150)]
    rows += [(2000 + i, f"{prose(51, 100)} {prose(60 + i, 22)}") for i in range(30)]
    rows += [(3000 + i, prose(90 + i, 4 + i)) for i in range(6)]
    return rows


@pytest.mark.parametrize("part_shingles", [2_000_000, 5_000])
def test_jaccard_components(spark, part_shingles):
    rows = [r for r in documents() if r[0] is not None] + near_copies()
    docs = frame(spark, [(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n long, sig long")
    got = jaccard_components(docs, scratch(spark), part_shingles=part_shingles).collect()
    want = by_brute_force(rows)
    assert len(got) == len(rows)
    for row in got:
        assert (row["n_shingles"], row["component_id"]) == want[row["doc_id"]], row["doc_id"]
    assert len({r["component_id"] for r in got}) < len(set(rows)) - 100


def test_jaccard_edges(spark):
    rows = [(None, "a b c d e f"), (None, "only here it is all"), (4, "A B C D E F"), (5, "")]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"])
           for r in jaccard_components(frame(spark, rows), scratch(spark)).collect()}
    assert got == {(None, 2, 4), (4, 2, 4), (None, 1, None), (5, 0, 5)}
    assert jaccard_components(frame(spark, []), scratch(spark)).count() == 0


def test_groups_do_not_percolate(spark, monkeypatch):
    """Passages and phrases that very many texts share chain no groups."""
    passage, phrases = prose(700, 60), [prose(710 + i, 12) for i in range(20)]
    rows = [(i, f"{prose(2000 + i, 90)} {phrases[i % 20]} {passage} {phrases[i % 19]} {prose(4000 + i, 60)}") for i in range(500)]
    rows += [(1000 + i, edited(rows[i][1], 0.01, i)) for i in range(0, 500, 5)]
    sizes, members = [], minhash._members

    def seen(*args):
        found = members(*args)
        sizes.extend(r["count"] for r in found.groupBy("family").count().collect())
        return found

    monkeypatch.setattr(minhash, "_members", seen)
    got = jaccard_components(frame(spark, rows), scratch(spark)).collect()
    want = by_brute_force(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert len(sizes) > 80 and max(sizes) <= 10  # the largest component has 2


@pytest.mark.parametrize("left", [0, 7, 60])
def test_links_in_a_task(left):
    rows = near_copies()[:170]
    sets = [shingle_set(t) for _, t in rows]
    plain = [set(x.tolist()) for x in sets]
    pairs = [(a, b) for a, b in itertools.combinations(range(len(sets)), 2)
             if similar(plain[a], plain[b]) and (not left or (a < left) != (b < left))]
    found = list(link(sets, left, 80))
    assert {tuple(sorted(x)) for x in found} <= set(pairs)
    assert roots(range(len(sets)), found) == roots(range(len(sets)), pairs)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 400)] + [(0, i) for i in range(1, 60)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)] + [(7, 7)]
    rng.shuffle(edges)
    want = roots({x for e in edges for x in e}, edges)
    for short in (0, 50_000):
        found = components(frame(spark, edges, "u long, v long"), scratch(spark), "x", short)
        assert {r["node"]: r["root"] for r in found.collect()} == {x: r for x, r in want.items() if x != r}
    assert components(frame(spark, [], "u long, v long"), scratch(spark), "y").count() == 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    item = prose(500, 30)
    rows = [r for r in documents() if r[0] is not None] + near_copies()
    rows = list(dict.fromkeys(rows)) + [(5000, f"{prose(501, 60)} {item}"), (5001, f"{item} {prose(502, 900)}")]
    rows += [(5010 + i, "# $ " * 40 + prose(600 + i, 60)) for i in range(3)]
    docs = frame(spark, [(i, t, "en", "s", len(t or "")) for i, t in rows],
                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    frame(spark, [(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame(spark, [], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = [x[0] for x in corpus_pipeline.STAGES]
    assert kept == ["quality rules", "line dedup", "n-gram jaccard join", "benchmark decontamination", "packing"]
    before = rows
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == corpus_pipeline.COLUMNS
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        after = sorted((r["doc_id"], r["text"]) for r in docs.collect())
        if i == 0:
            assert set(after) < set(before) and not {5010, 5011, 5012} & {x for x, _ in after}
            for doc_id, text in after:
                n, _, _, _, repeats = base_counts(text)
                assert n >= 50 and 100 * repeats <= 50 * n, doc_id
        elif i == 1:
            assert after == [x[:2] for x in kept_lines(before)]
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
        elif i == 2:
            want = by_brute_force(before)
            assert [x for x, _ in after] == sorted(x for x in want if want[x][1] == x)
        else:
            dirty = {x[0] for x in contamination(before, [(1, item)], 13) if x[4]}
            assert dirty == {5000} and after == [x for x in before if x[0] not in dirty]
        before = after
    assert {5001, 1000} <= {x for x, _ in before}
    pieces = {tuple(r) for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "start", "doc_tokens").collect()}
    assert {x for x, _, _ in pieces} == {x for x, _ in before}
    assert {(i, n) for i, _, n in pieces} == {(r["doc_id"], r["doc_tokens"]) for r in packed(docs).collect()}
