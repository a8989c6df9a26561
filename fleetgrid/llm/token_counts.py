"""Token counts from a cache of digests: only texts that it does not know are encoded."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrid.llm.common import SPACES, ship_package
from fleetgrid.llm.encoder import WordCounter, loaded, slices

CACHE_SCHEMA = "digest binary, n_tokens long"


def tokenizer_version(path: str) -> str:
    """The digest of the tokenizer's file: another file never uses this one's counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


def normalised(text: Column) -> Column:
    """Null as empty, each run of white space as one space. The vocabulary drops white
    space, so texts that are equal after this have equal counts."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", " ")


def _digest(normal: Column) -> Column:
    return F.unhex(F.sha2(normal, 256))


def _of_version(cache: str, version: str) -> str:
    """The part of the cache that holds a version's counts."""
    return f"{cache.rstrip('/')}/version={version}"


def read_cache(spark: SparkSession, cache: str, version: str) -> DataFrame | None:
    """Stored counts of a tokenizer version; none if there are none yet. Those of other
    versions are not looked at."""
    path = _of_version(cache, version)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(at):
        return None
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path)
    # Two runs that append at the same time may store the same digest twice.
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def append_misses(docs: DataFrame, cache: str, tokenizer: str) -> None:
    """Encodes each distinct text that the cache does not know, and appends its count.

    A map task passes a text on once, however often it has it, so a text with very many
    copies does not gather in the task that encodes it.
    """
    ship_package(docs.sparkSession)
    version = tokenizer_version(tokenizer)
    texts = docs.select(normalised(F.col("text")).alias("text"))
    texts = texts.select(_digest(F.col("text")).alias("digest"), "text")

    def once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            new = []
            for i, digest in enumerate(batch.column(0).to_pylist()):
                if digest not in seen:
                    seen.add(digest)
                    new.append(i)
            if new:
                yield batch.take(pa.array(new))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(WordCounter, tokenizer)
        for batch in once(batches):
            digests, texts = (batch.column(i).to_pylist() for i in range(2))
            counts = [n for some in slices(texts) for n in counter.count(texts[some])]
            columns = [pa.array(digests, pa.binary()), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "n_tokens"])

    misses = texts.mapInArrow(once, "digest binary, text string").repartition("digest")
    known = read_cache(docs.sparkSession, cache, version)
    if known is not None:  # partitioned alike: the texts are not moved again
        misses = misses.join(known, "digest", "left_anti")
    stored = misses.mapInArrow(counted, CACHE_SCHEMA).write.mode("append")
    stored.parquet(_of_version(cache, version))


def count_tokens(docs: DataFrame, cache: str, tokenizer: str) -> DataFrame:
    """`doc_id, n_bytes, n_tokens` for every row of `doc_id, text`.

    Null texts are empty: no bytes, no tokens. Repeated rows each have their row. Other
    columns are ignored. The path `cache` holds the counts of earlier calls.
    """
    append_misses(docs, cache, tokenizer)
    counts = read_cache(docs.sparkSession, cache, tokenizer_version(tokenizer))
    text = F.col("text")
    narrow = docs.select(
        "doc_id",
        F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"),
        _digest(normalised(text)).alias("digest"),
    )
    return narrow.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens")
