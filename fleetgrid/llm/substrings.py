"""Passages that repeat across documents: sliding spans of sentences."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetgrid.llm.common import Scratch, boxed, row_key, same_key, ship_package, unboxed

_END = re.compile(r"[.!?]+\s+|\n\s*")
_WORD = re.compile(r"\S+\s*")


@dataclass(frozen=True)
class Spans:
    """A span starts at every sentence and is the shortest run of at least `sentences`
    sentences and `words` words. A sentence of more than `longest` words counts as several:
    it is cut after words that their hash picks, one in `longest / 2`, and at the latest
    after `longest` words. So equal words are cut alike soon after an edit before them."""

    sentences: int = 3
    words: int = 20
    longest: int = 16


def sentences(text: str, longest: int) -> tuple[list[int], list[str]]:
    """Where each sentence ends, white space after it included, and its normal form."""
    ends, normal, start = [], [], 0
    stops = [m.end() for m in _END.finditer(text)]
    if not stops or stops[-1] < len(text):
        stops.append(len(text))
    for stop in stops:
        words = text[start:stop].split()
        if len(words) <= longest:
            if words or not ends:
                ends.append(stop)
                normal.append(" ".join(words).lower())
            else:
                ends[-1] = stop
        else:
            at = [m.end() for m in _WORD.finditer(text, start, stop)]
            first = 0
            for i, word in enumerate(words, 1):
                picked = xxhash.xxh3_64_intdigest(word.lower()) % (longest // 2) == 0
                if i == len(words) or picked or i - first == longest:
                    ends.append(stop if i == len(words) else at[i - 1])
                    normal.append(" ".join(words[first:i]).lower())
                    first = i
        start = stop
    return ends, normal


def span_ends(normal: list[str], rule: Spans) -> np.ndarray:
    """For each sentence that starts a span, the number of the sentence after its end."""
    n = len(normal)
    total = np.concatenate([[0], np.cumsum([x.count(" ") + 1 if x else 0 for x in normal])])
    ends = np.searchsorted(total, total[:n] + rule.words)
    ends = np.maximum(ends, np.arange(n) + rule.sentences)
    return ends[ends <= n]


def _spans(docs: DataFrame, rule: Spans) -> DataFrame:
    """`key_id, key_text, hash, first, last`; `hash` is null where the same document has
    the span earlier, so that this one is never a first."""

    def found(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, hashes, firsts, lasts = [], [], [], []
            for text in batch.column(2).to_pylist():
                _, normal = sentences(text or "", rule.longest)
                ends, seen = span_ends(normal, rule), set()
                lengths.append(len(ends))
                for i, end in enumerate(ends.tolist()):
                    own = xxhash.xxh3_64_intdigest("\n".join(normal[i:end])) - (1 << 63)
                    hashes.append(None if own in seen else own)
                    seen.add(own)
                    firsts.append(i)
                    lasts.append(end)
            rows = pa.array(np.repeat(np.arange(len(lengths)), lengths))
            keys = [batch.column(i).take(rows) for i in range(2)]
            places = [pa.array(x, pa.int32()) for x in (firsts, lasts)]
            yield pa.RecordBatch.from_arrays(
                [*keys, pa.array(hashes, pa.int64()), *places],
                ["key_id", "key_text", "hash", "first", "last"],
            )

    schema = "key_id long, key_text long, hash long, first int, last int"
    return docs.select(*row_key(), "text").mapInArrow(found, schema)


def remove_repeats(docs: DataFrame, scratch: Scratch, rule: Spans = Spans()) -> DataFrame:
    """All columns of `docs` with `text` less its repeated passages, `n_sentences` and
    `n_removed`.

    A span occurs again where its sentences are equal but for case and white space. Its
    first occurrence, in the document with the smallest `doc_id` and there the earliest,
    stays; sentences that any other occurrence covers are removed, and what is left
    keeps its own white space. A null id counts as larger than all others. A null text
    stays null, with no sentences; an empty one has a single, empty sentence. Rows with the
    same id and text are one document, and each has its row; documents that share an id
    are one document for what comes first. Columns with the added names are replaced.
    """
    ship_package(docs.sparkSession)
    spans = scratch.table("spans", _spans(docs, rule))
    again = spans.where("hash is null")
    distinct = spans.where("hash is not null")
    firsts = distinct.groupBy("hash").agg(
        F.min("key_id").alias("keeper"), F.count(F.lit(1)).alias("n")
    )
    firsts = firsts.where("n > 1").select("hash", "keeper")
    later = distinct.join(firsts, "hash").where(~F.col("key_id").eqNullSafe(F.col("keeper")))
    places = ["key_id", "key_text", "first", "last"]
    covered = later.select(places).union(again.select(places))
    covered = covered.groupBy("key_id", "key_text").agg(
        F.collect_set(F.struct("first", "last")).alias("covered")
    )
    covered = scratch.table("covered", covered)
    scratch.drop("spans")

    names, columns = boxed(docs, ["n_sentences", "n_removed"])
    left = docs.select(columns)
    joined = left.join(covered.hint("merge"), same_key(left, covered), "left")
    joined = joined.select("_row", "_text", "covered")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, removed = [], [], []
            columns = (batch.column(i).to_pylist() for i in (1, 2))
            for text, places in zip(*columns, strict=True):
                ends, _ = sentences(text, rule.longest) if text is not None else ([], [])
                drop = np.zeros(len(ends), bool)
                for place in places or ():
                    drop[place["first"] : place["last"]] = True
                if drop.any():
                    starts = [0, *ends[:-1]]
                    keep = np.flatnonzero(~drop).tolist()
                    text = "".join([text[starts[i] : ends[i]] for i in keep])
                texts.append(text)
                counts.append(len(ends))
                removed.append(int(drop.sum()))
            added = [pa.array(x, pa.int64()) for x in (counts, removed)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), *added],
                ["_row", "_text", "n_sentences", "n_removed"],
            )

    row = StructType([joined.schema["_row"], joined.schema["_text"]])
    done = joined.mapInArrow(cut, row.add("n_sentences", "long").add("n_removed", "long"))
    return done.select(*unboxed(names), "n_sentences", "n_removed")
