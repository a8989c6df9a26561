"""Token files, token counts and packing, against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetgrid.llm.encoder import PieceEncoder, WordCounter
from fleetgrid.llm.packing import Limits, Packer, pack
from fleetgrid.llm.queries import packed
from fleetgrid.llm.token_counts import count_tokens, read_cache, tokenizer_version
from fleetgrid.llm.token_files import (
    read_token_files,
    vbyte_decode,
    vbyte_encode,
    write_token_files,
)
from tests.llm.cases import documents, frame, scratch

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(BYTES)
WORD_LIBRARY = Tokenizer.from_file(WORDS)
ENCODER, COUNTER = PieceEncoder(BYTES, limit=50), WordCounter(WORDS, limit=50)


def ids_of(text):
    return np.array(LIBRARY.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


ODD = ["a  b", " a", "a \n b", "it's don't 're", "x,. y..", "é,É. ß!", "<|endoftext|> z", "\x85 \x1c",
       "a\nb. C\nd", "12,3 4.", "word　word", "ΑΣ Σ", "á b", "ﬁn", "", " ", "\n"]


@given(st.lists(st.sampled_from(ODD) | st.text(max_size=12), max_size=6))
def test_pieces_have_the_ids_of_the_whole(parts):
    texts = [" ".join(parts), "".join(parts)]
    assert ENCODER.encode(texts) == [ids_of(x) for x in texts]
    lengths = [len(WORD_LIBRARY.encode(x, add_special_tokens=False).ids) for x in texts]
    assert COUNTER.count(texts) == lengths


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_vbyte_round_trip(values):
    control, data = vbyte_encode(np.array(values, "<u4"))
    assert vbyte_decode(control, data, len(values), step=3).tolist() == values
    assert len(control) == -(-len(values) // 4)


def test_token_files_round_trip(spark):
    rows = documents()
    path = f"{scratch(spark).path}/tokens"
    docs = frame(spark, [(i, t, 1, "x") for i, t in rows], "doc_id long, text string, part int, ids string")
    write_token_files(docs, path, BYTES, block_ids=5000)
    got = read_token_files(spark, path).orderBy("start").collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for doc_id, text in ordered:
        ids = ids_of(text) + bytes(4)
        want.append((doc_id, start, len(ids) // 4, ids))
        start += len(ids) // 4
    assert [tuple(r) for r in got] == want


def test_token_counts_and_cache(spark):
    rows, cache = documents(), f"{scratch(spark).path}/cache"
    docs = frame(spark, [(i, t, 7) for i, t in rows], "doc_id long, text string, n_tokens int")
    want = sorted(
        (i or -1, len((t or "").encode()), len(WORD_LIBRARY.encode(t or "", add_special_tokens=False).ids))
        for i, t in rows
    )

    def result():
        return sorted((r[0] or -1, r[1], r[2]) for r in count_tokens(docs, cache, WORDS).collect())

    assert result() == want
    stored = read_cache(spark, cache, tokenizer_version(WORDS)).count()
    assert result() == want  # all known now
    assert spark.read.parquet(cache).count() == stored
    more = frame(spark, [(1, "something   new"), (2, "something new")])
    assert [r[2] for r in count_tokens(more, cache, WORDS).collect()] == [2, 2]
    assert spark.read.parquet(cache).count() == stored + 1


def sequences_of(pieces):
    out = defaultdict(list)
    for p in pieces:
        out[p["sequence_id"]].append(p)
    return [sorted(x, key=lambda p: p["offset"]) for x in out.values()]


def test_packing_keeps_every_id_once_and_pads_nothing(spark):
    rows = documents()
    docs = frame(spark, [(i, t, 5) for i, t in rows], "doc_id long, text string, length int")
    pieces = [r.asDict() for r in packed(docs.coalesce(2)).collect()]
    for sequence in sequences_of(pieces):
        total = sum(p["length"] for p in sequence)
        assert total & (total - 1) == 0 and total <= 1024
        assert [p["offset"] for p in sequence] == np.cumsum([0] + [p["length"] for p in sequence])[:-1].tolist()
    whole = {i: ids_of(t) + bytes(4) for i, t in rows}
    for p in pieces:
        ids = whole[p["doc_id"]][4 * p["start"] : 4 * (p["start"] + p["length"])]
        assert p["ids_crc32"] == zlib.crc32(ids) and p["doc_tokens"] == len(whole[p["doc_id"]]) // 4
    covered = defaultdict(int)
    for p in pieces:
        covered[p["doc_id"]] += p["length"]
    times = {i: [x for x, _ in rows].count(i) for i in whole}
    assert covered == {i: times[i] * len(x) // 4 for i, x in whole.items()}


@pytest.mark.parametrize("limits", [Limits(64, 3, 40), Limits(64, 1, 64), Limits(10, 5, 1)])
def test_packing_holds_all_limits(limits):
    rng = np.random.default_rng(3)
    packer = Packer(limits, 5, pool=16)
    sizes = {i: int(n) for i, n in enumerate(rng.integers(1, 200, 150))}
    for i, n in sizes.items():
        packer.add(i, bytes(4 * n), int(rng.integers(0, n + 1)))
    packer.finish()
    by_sequence, covered = defaultdict(list), defaultdict(list)
    for doc, start, length, ids, _, sequence, _, loss in packer.out:
        assert len(ids) == 4 * length
        by_sequence[sequence].append((length, loss))
        covered[doc] += range(start, start + length)
    for held in by_sequence.values():
        assert len(held) <= limits.segments
        assert sum(x for x, _ in held) <= limits.tokens and sum(x for _, x in held) <= limits.loss
    assert {i: sorted(x) for i, x in covered.items()} == {i: list(range(n)) for i, n in sizes.items()}


def test_prompts_bear_no_loss(spark):
    docs = frame(spark, [(1, "a b c d e", 3), (2, "f g", None)], "doc_id long, text string, prompt int")
    got = {r["doc_id"]: r["n_loss"] for r in pack(docs, BYTES, prompt_tokens="prompt").groupBy("doc_id").agg({"n_loss": "sum"}).toDF("doc_id", "n_loss").collect()}
    assert got == {1: 3, 2: 3}


def test_empty_tables(spark):
    none = frame(spark, [])
    path = scratch(spark).path
    write_token_files(none, f"{path}/tokens", BYTES)
    assert read_token_files(spark, f"{path}/tokens").count() == 0
    assert count_tokens(none, f"{path}/cache", WORDS).count() == 0
    assert packed(none).count() == 0
