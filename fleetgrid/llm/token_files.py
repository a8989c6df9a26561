"""Token ids in files: frequency-ranked, byte-aligned variable-length coding.

File format: a Parquet table of blocks, written by Spark, so that any store and any
lost task is handled by Spark's own committer. A block holds whole documents in
ascending order of id:

- `part`, `block`: the range of ids that wrote it, and its number there;
- `local_start`: ids in the blocks of the same part before it;
- `doc_ids`, `lengths`: its documents and their counts of ids;
- `ranking`: the block's ids by falling frequency, as little-endian unsigned 32-bit integers;
- `control`, `data`: the ranks in stream-vbyte form. Each value takes the one to four
  bytes that it needs, in `data`; four values share a control byte, two bits each, in
  the order of the values, low bits first.

Frequent ids have small ranks and take a single byte. Each block ranks its own ids: all
of them count, and one pass over the corpus is enough.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrid.llm.common import ship_package
from fleetgrid.llm.encoder import PieceEncoder, loaded, slices

BLOCK_SCHEMA = (
    "part int, block int, local_start long, n_ids long, doc_ids array<bigint>, "
    "lengths array<bigint>, ranking binary, control binary, data binary"
)
BLOCK_COLUMNS = ["doc_ids", "lengths", "ranking", "control", "data"]
END_ID = 0


def _control_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each control byte: the bytes that its values take, and where each of the 16
    bytes of four 32-bit integers comes from (16: nowhere, a zero)."""
    lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
    starts = np.cumsum(lengths, axis=1) - lengths
    byte = np.arange(4)
    take = np.where(byte < lengths[:, :, None], starts[:, :, None] + byte, 16)
    return lengths.sum(axis=1), take.reshape(256, 16)


_TAKEN, _TAKE = _control_tables()


def vbyte_encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit integers."""
    values = values.astype("<u4")
    extra = (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.zeros((len(values) + 3) // 4 * 4, np.uint8)
    quads[: len(values)] = extra
    control = quads.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)
    needed = np.arange(4) <= extra[:, None]
    data = values.view(np.uint8).reshape(-1, 4)[needed]
    return np.bitwise_or.reduce(control, axis=1).astype(np.uint8).tobytes(), data.tobytes()


def vbyte_decode(control: bytes, data: bytes, n: int, step: int = 1 << 16) -> np.ndarray:
    """The `n` integers again, by table lookup, `step` control bytes at a time."""
    controls, out, at = np.frombuffer(control, np.uint8), [], 0
    # the last values may be filled up: their bytes are read as zeros
    padded = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(32, np.uint8)])
    for i in range(0, len(controls), step):
        some = controls[i : i + step]
        ends = np.cumsum(_TAKEN[some])
        take = _TAKE[some]
        index = np.where(take < 16, take + (at + ends - _TAKEN[some])[:, None], len(padded) - 1)
        out.append(padded[np.minimum(index, len(padded) - 1)].reshape(-1).view("<u4"))
        at += int(ends[-1])
    return np.concatenate(out)[:n] if out else np.empty(0, "<u4")


def _block(part: int, number: int, start: int, docs: list[tuple[int, bytes]]) -> dict:
    ids = np.frombuffer(b"".join(x for _, x in docs), "<u4")
    counts = np.bincount(ids)
    used = np.flatnonzero(counts)
    ranking = used[np.argsort(-counts[used], kind="stable")].astype("<u4")
    rank = np.empty(len(counts), "<u4")
    rank[ranking] = np.arange(len(ranking))
    control, data = vbyte_encode(rank[ids])
    return {
        "part": part,
        "block": number,
        "local_start": start,
        "n_ids": len(ids),
        "doc_ids": [x for x, _ in docs],
        "lengths": [len(x) // 4 for _, x in docs],
        "ranking": ranking.tobytes(),
        "control": control,
        "data": data,
    }


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, block_ids: int = 2_000_000
) -> None:
    """Encodes `doc_id, text` and writes the files, in ascending order of `doc_id`.

    Null texts are empty. Each document ends with id 0. Null ids come first; documents
    of the same id stand in the order of their texts. Other columns are ignored. A block
    has `block_ids` ids or the documents that first pass it.
    """
    ship_package(docs.sparkSession)
    end = END_ID.to_bytes(4, "little")

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = loaded(PieceEncoder, tokenizer), TaskContext.get().partitionId()
        number = start = size = 0
        pending: list[tuple[int, bytes]] = []

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(part, number, start, pending)], _ARROW)

        for batch in batches:
            ids, texts = (batch.column(i).to_pylist() for i in range(2))
            for some in slices(texts):
                for doc_id, encoded in zip(ids[some], encoder.encode(texts[some]), strict=True):
                    pending.append((doc_id, encoded + end))
                    size += len(encoded) // 4 + 1
                    if size >= block_ids:
                        yield close()
                        number, start, size, pending = number + 1, start + size, 0, []
        if pending:
            yield close()

    text = F.coalesce("text", F.lit("")).alias("text")
    ordered = docs.select("doc_id", text).repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions("doc_id", "text")
    table = ordered.mapInArrow(blocks, BLOCK_SCHEMA)
    table.write.option("compression", "zstd").parquet(path)


_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("local_start", pa.int64()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("ranking", pa.binary()),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids` of every document in the files.

    `start` counts the ids of all documents before it; `ids` are little-endian unsigned
    32-bit integers. The driver gets one number for each part that wrote files.
    """
    ship_package(spark)
    table = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    sizes = table.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    before, offsets = 0, {}
    for row in sizes:
        offsets[row["part"]] = before
        before += row["n"]

    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ranks = vbyte_decode(row["control"], row["data"], row["n_ids"])
                ids = np.frombuffer(row["ranking"], "<u4")[ranks]
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                starts = ends - lengths
                step = 1000
                for i in range(0, len(lengths), step):
                    some = slice(i, i + step)
                    cut = [ids[a:b].tobytes() for a, b in zip(starts[some], ends[some])]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(row["doc_ids"][some], pa.int64()),
                            pa.array(starts[some] + row["local_start"] + offsets[row["part"]]),
                            pa.array(lengths[some]),
                            pa.array(cut, pa.binary()),
                        ],
                        ["doc_id", "start", "n_tokens", "ids"],
                    )

    columns = table.select("part", "local_start", "n_ids", *BLOCK_COLUMNS)
    return columns.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids binary")

