"""Packing of examples into sequences under several limits at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import ship_package
from fleetgrid.llm.encoder import PieceEncoder, loaded, slices

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, "
    "sequence_id long, offset long, n_loss long"
)
_ARROW = pa.schema(
    [
        (name, pa.binary() if name == "ids" else pa.int64())
        for name in (x.split()[0] for x in PIECE_SCHEMA.split(", "))
    ]
)


@dataclass(frozen=True)
class Limits:
    """What a sequence may hold: tokens, pieces, and tokens that bear loss."""

    tokens: int = 1024
    segments: int = 64
    loss: int = 1024


@dataclass(frozen=True)
class Piece:
    doc_id: int | None
    ids: bytes  # of the whole document
    start: int
    length: int
    prompt: int  # leading ids of the document without loss

    @property
    def loss(self) -> int:
        return max(0, self.start + self.length - max(self.start, self.prompt))

    def head(self, tokens: int, loss: int) -> int:
        """Length of the longest head within so many tokens and loss-bearing tokens."""
        free = max(0, min(self.length, self.prompt - self.start))
        return min(self.length, tokens, free + loss)

    def cut(self, length: int) -> tuple[Piece, Piece]:
        rest = Piece(
            self.doc_id, self.ids, self.start + length, self.length - length, self.prompt
        )
        return Piece(self.doc_id, self.ids, self.start, length, self.prompt), rest


class Packer:
    """Vector bin packing with a pool of waiting pieces.

    The open sequence takes the piece whose demand has the largest dot product with
    what the sequence has left, both as shares of the limits, among pieces that fit. When none
    fits, the best one is cut. The pool bounds memory, and its size costs no result:
    every piece leaves it in the end. What remains at the very end fills sequences whose
    lengths are powers of two, which need no padding.
    """

    def __init__(self, limits: Limits, first_sequence: int, pool: int = 256):
        if min(limits.tokens, limits.segments, limits.loss) < 1:
            raise ValueError("limits must be positive")
        self.limits, self._next, self._pool_size = limits, first_sequence, pool
        self._scale = 1 / np.array([limits.tokens, limits.segments, limits.loss], float)
        self._pool: list[Piece] = []
        self._demand = np.zeros((3, 2 * pool + 2))
        self.out: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes, prompt: int) -> None:
        rest = Piece(doc_id, ids, 0, len(ids) // 4, prompt)
        while rest.length:
            head, rest = rest.cut(rest.head(self.limits.tokens, self.limits.loss))
            if head.length == self.limits.tokens:
                self._emit([head])
            else:
                self._put(head)
        while len(self._pool) >= self._pool_size:
            self._fill()

    def finish(self) -> None:
        while self._pool:
            self._fill()

    def _put(self, piece: Piece) -> None:
        if len(self._pool) == self._demand.shape[1]:
            self._demand = np.concatenate([self._demand, np.zeros_like(self._demand)], axis=1)
        self._demand[:, len(self._pool)] = piece.length, 1, piece.loss
        self._pool.append(piece)

    def _take(self, i: int) -> Piece:
        piece, last = self._pool[i], self._pool.pop()
        if i < len(self._pool):
            self._pool[i] = last
            self._demand[:, i] = self._demand[:, len(self._pool)]
        return piece

    def _fill(self) -> None:
        tokens, segments, loss = self.limits.tokens, self.limits.segments, self.limits.loss
        chosen: list[Piece] = []
        while self._pool and tokens and segments:
            demand = self._demand[:, : len(self._pool)]
            left = np.array([tokens, segments, loss], float)
            score = (left * self._scale**2) @ demand
            fits = (demand[0] <= tokens) & (demand[2] <= loss)
            if segments > 1 and fits.any():
                piece = self._take(int(np.argmax(np.where(fits, score, -1.0))))
            else:  # nothing fits, or the last segment has to fill the sequence
                i = int(np.argmax(np.minimum(demand[0], tokens) + score / 8))
                length = self._pool[i].head(tokens, loss)
                if not length:
                    break
                piece, rest = self._take(i).cut(length)
                if rest.length:
                    self._put(rest)
            chosen.append(piece)
            tokens, segments, loss = tokens - piece.length, segments - 1, loss - piece.loss
        if self._pool or not tokens:
            self._emit(chosen)
        else:
            self._emit_by_powers(chosen)

    def _emit(self, pieces: list[Piece]) -> None:
        offset = 0
        for p in pieces:
            ids = p.ids[4 * p.start : 4 * (p.start + p.length)]
            row = (p.doc_id, p.start, p.length, ids, len(p.ids) // 4, self._next, offset, p.loss)
            self.out.append(row)
            offset += p.length
        self._next += 1

    def _emit_by_powers(self, pieces: list[Piece]) -> None:
        """One sequence for each power of two in the sum of the lengths."""
        left, waiting = sum(p.length for p in pieces), list(reversed(pieces))
        while left:
            room = power = 1 << (left.bit_length() - 1)
            chosen = []
            while room:
                head, rest = (p := waiting.pop()).cut(min(room, p.length))
                if rest.length:
                    waiting.append(rest)
                chosen.append(head)
                room -= head.length
            self._emit(chosen)
            left -= power


def pack(
    docs: DataFrame,
    tokenizer: str,
    limits: Limits = Limits(),
    prompt_tokens: str | None = None,
    end_id: int = 0,
) -> DataFrame:
    """Packs every document, cut where needed, into sequences within `limits`.

    Each partition packs its own documents, without a shuffle; its sequence ids start at
    its number times 2**40. Null texts are empty; a document ends with `end_id`, so each
    has at least one id. `prompt_tokens` names a column with the count of leading ids
    that bear no loss (null or none: 0). Repeated rows are packed as often as they occur.
    Other columns are ignored. `n_loss` counts a piece's loss-bearing ids.
    """
    ship_package(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def sequences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(PieceEncoder, tokenizer)
        packer = Packer(limits, TaskContext.get().partitionId() << 40)

        def flushed() -> pa.RecordBatch:
            columns = zip(*packer.out, strict=True)
            arrays = [pa.array(x, f.type) for x, f in zip(columns, _ARROW, strict=True)]
            packer.out = []
            return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)

        for batch in batches:
            ids, texts, prompts = (batch.column(i).to_pylist() for i in range(3))
            for some in slices(texts):
                encoded = encoder.encode(texts[some])
                for doc_id, x, prompt in zip(ids[some], encoded, prompts[some], strict=True):
                    packer.add(doc_id, x + end, prompt)
                if packer.out:
                    yield flushed()
        packer.finish()
        if packer.out:
            yield flushed()

    prompt = F.coalesce(F.col(prompt_tokens), F.lit(0)) if prompt_tokens else F.lit(0)
    text = F.coalesce("text", F.lit(""))
    columns = docs.select("doc_id", text.alias("text"), prompt.cast("long").alias("prompt"))
    return columns.mapInArrow(sequences, PIECE_SCHEMA)
