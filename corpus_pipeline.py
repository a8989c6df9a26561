"""The corpus pipeline: from raw documents to packed training sequences.

Each stage works on what the stage before it kept, written and read again as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, read_table, row_key, same_key
from fleetgrid.llm.decontamination import mark_contaminated
from fleetgrid.llm.jaccard import jaccard_components
from fleetgrid.llm.lines import drop_shared_lines
from fleetgrid.llm.quality import (
    FLAGGED_SHARE,
    RULES,
    judge,
    order_rules,
    toxic_markers,
    toxic_words,
)
from fleetgrid.llm.queries import QUERIES as OPERATOR_QUERIES
from fleetgrid.llm.queries import packed

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(
    spark: SparkSession, docs: DataFrame, sf_dir: str, use_labels: bool = True
) -> DataFrame:
    """Documents that no rule rejects, nor their toxic words, as learned from `labels`.

    Without `use_labels`, the fixed rules alone decide; else the table has to be there.
    """
    rules = [FLAGGED_SHARE if r.name == FLAGGED_SHARE.name else r for r in RULES]
    if use_labels:
        stems, words = toxic_markers(docs, read_table(spark, sf_dir, "labels"))
        if stems or words:
            rules.append(toxic_words(stems, words))
    return judge(docs, order_rules(docs, rules)).where("kept").select(COLUMNS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that others of them keep. `n_chars` follows."""
    kept = drop_shared_lines(docs, Scratch(spark, "pipeline-lines"))
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(COLUMNS)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    scratch = Scratch(spark, "pipeline-jaccard")
    groups = jaccard_components(docs, scratch)
    first = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = first.select(F.col("doc_id").alias("key_id"), "key_text").distinct()
    first = scratch.table("first", first)
    keyed = docs.select(*COLUMNS, *row_key())
    return keyed.join(first.hint("merge"), same_key(keyed, first), "left_semi").select(COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    marked = mark_contaminated(docs, benchmark, Scratch(spark, "pipeline-benchmark"))
    return marked.where("not contaminated").select(COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packed(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

# Packing cuts texts into ids of a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`. Each stage's table is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        docs = scratch.table(str(i), stage(spark, docs, sf_dir))
        if i:
            scratch.drop(str(i - 1))
    return docs


QUERIES = OPERATOR_QUERIES | {"pipeline": run}
