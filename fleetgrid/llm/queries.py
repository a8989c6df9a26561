"""The registered queries of this package, each with its operator's production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, read_table
from fleetgrid.llm.decontamination import mark_contaminated
from fleetgrid.llm.jaccard import jaccard_components
from fleetgrid.llm.lexical_search import search
from fleetgrid.llm.lines import drop_shared_lines
from fleetgrid.llm.minhash import minhash_components
from fleetgrid.llm.packing import pack
from fleetgrid.llm.pages import extract_main_text
from fleetgrid.llm.prefix_trie import conversation_trie
from fleetgrid.llm.private_data import describe_spans, find_private_data
from fleetgrid.llm.quality import judge
from fleetgrid.llm.substrings import remove_repeats
from fleetgrid.llm.token_counts import count_tokens
from fleetgrid.llm.token_files import read_token_files, write_token_files

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, Scratch(spark, "op1"))


def op2_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = describe_spans(find_private_data(docs, Scratch(spark, "op2")))
    base = F.sha2("base", 256).alias("base_sha256")
    return spans.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", base, "spans")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    kept = drop_shared_lines(docs.select("doc_id", "text"), Scratch(spark, "op3"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    benchmark = read_table(spark, sf_dir, "benchmark")
    marked = mark_contaminated(docs, benchmark, Scratch(spark, "op4"))
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return jaccard_components(docs, Scratch(spark, "op5")).drop("key_text")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{Scratch(spark, 'op6').path}/tokens"
    docs = read_table(spark, sf_dir, "documents")
    write_token_files(docs, path, tokenizer_path("byte_bpe_50k.json"))
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cache = f"{Scratch(spark, 'op7').path}/cache"
    docs = read_table(spark, sf_dir, "documents")
    counts = count_tokens(docs, cache, tokenizer_path("word_bpe_49k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def packed(docs: DataFrame) -> DataFrame:
    pieces = pack(docs, tokenizer_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read_table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_main_text(read_table(spark, sf_dir, "pages"), Scratch(spark, "op9"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixed rules alone, as SQL can state them: a toxic text without two of the listed
    insults is kept. The pipeline's stage, which also learns from `labels`, is the stronger one."""
    docs = read_table(spark, sf_dir, "documents")
    return judge(docs.select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_components(read_table(spark, sf_dir, "documents"), Scratch(spark, "op11"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (read_table(spark, sf_dir, x) for x in ("documents", "benchmark"))
    return search(docs, items, Scratch(spark, "op12"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(read_table(spark, sf_dir, "conversations"), Scratch(spark, "op13"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_private_data": op2_private_data,
    "op3_line_dedup": op3_line_dedup,
    "op4_decontamination": op4_decontamination,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_token_files": op6_token_files,
    "op7_token_counts": op7_token_counts,
    "op8_packing": op8_packing,
    "op9_html_extraction": op9_html_extraction,
    "op10_quality_rules": op10_quality_rules,
    "op11_minhash_dedup": op11_minhash_dedup,
    "op12_lexical_search": op12_lexical_search,
    "op13_prefix_trie": op13_prefix_trie,
}
