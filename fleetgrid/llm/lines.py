"""Removal of lines that many documents share, by keep bitmaps instead of texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetgrid.llm.common import Scratch, boxed, lower_ascii, row_key, same_key, unboxed

TRIMMED = " \t\n\x0b\x0c\r"
# Copies of one line are spread over so many chunks, which range partitions can part.
_CHUNKS = 64


def _text() -> Column:
    return F.coalesce("text", F.lit(""))


def _occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """`hash, more, chunk, key_id, key_text, position` of every line whose key is long enough.

    Lines are told apart by the 128 bits of `hash` and `more`."""
    lines = F.split(lower_ascii(_text()), "\n")
    df = docs.select(*row_key(), F.posexplode(lines).alias("position", "line"))
    key = F.btrim("line", F.lit(TRIMMED))
    chunk = F.pmod(F.xxhash64("key_id", "key_text"), F.lit(_CHUNKS)).cast("int")
    # a key is never longer than its line
    df = df.where((F.char_length("line") >= min_chars) & (F.char_length(key) >= min_chars))
    hashed = [F.xxhash64(key).alias("hash"), F.xxhash64(F.lit(1), key).alias("more")]
    return df.select(*hashed, chunk.alias("chunk"), "key_id", "key_text", "position")


def drop_bitmaps(
    docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """`key_id, key_text, dropped`: the lines to drop of each document that loses some.

    `dropped` is a compressed bitmap: for each block of 64 lines with a line to drop, in
    order, the block's number and its 64 bits. Lines not in it are kept.

    The hashes are range-partitioned, sorted by hash, document and position, and read as
    a stream: the first row of a document in its run counts the document. A line's run
    is cut into chunks by document, so that a very common line is spread over partitions;
    the counts of the chunks are then summed.
    """
    occurrences = scratch.table("lines", _occurrences(docs, min_chars))
    ranged = occurrences.repartitionByRange("hash", "more", "chunk").sortWithinPartitions(
        "hash", "more", "chunk", "key_id", "key_text", "position"
    )
    run = Window.partitionBy("hash", "more", "chunk").orderBy("key_id", "key_text", "position")
    is_first = ~(
        F.lag("key_id").over(run).eqNullSafe(F.col("key_id"))
        & F.lag("key_text").over(run).eqNullSafe(F.col("key_text"))
    )
    firsts = ranged.withColumn("first", is_first).where("first")
    chunks = firsts.groupBy("hash", "more", "chunk").agg(
        F.count(F.lit(1)).alias("n"), F.max("key_id").alias("keeper")
    )
    shared = chunks.groupBy("hash", "more").agg(
        F.sum("n").alias("n"), F.max("keeper").alias("keeper")
    )
    shared = scratch.table("shared", shared.where(F.col("n") >= min_docs).drop("n"))
    dropped = occurrences.join(shared, ["hash", "more"]).where(
        ~F.col("key_id").eqNullSafe(F.col("keeper"))
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("position") % 64)
    block = (F.col("position") / 64).cast("int").alias("block")
    blocks = dropped.groupBy("key_id", "key_text", block).agg(F.bit_or(bit).alias("bits"))
    pairs = F.sort_array(F.collect_list(F.struct("block", "bits")))
    return blocks.groupBy("key_id", "key_text").agg(pairs.alias("dropped"))


def drop_shared_lines(
    docs: DataFrame, scratch: Scratch, min_chars: int = 40, min_docs: int = 5
) -> DataFrame:
    """All columns of `docs` with `text` less its shared lines, `n_lines` and `n_dropped`.

    A line's key is the line without white space at its ends and with A-Z in lower case.
    Keys of at least `min_chars` code points in at least `min_docs` documents lose all
    their lines except in the largest `doc_id` that holds them. The other lines stay as
    they are and are joined by line feeds; `n_lines` counts the lines before.

    A null or empty text is one empty line; its text becomes empty. Documents are told
    apart by id and text: rows that repeat both are one document, and each of them has
    its row. A null id is a document's id like any other, smaller than all others.
    Columns named `n_lines` or `n_dropped` are replaced.
    """
    bitmaps = drop_bitmaps(docs, scratch, min_chars, min_docs)
    bitmaps = scratch.table("bitmaps", bitmaps)
    scratch.drop("lines")
    scratch.drop("shared")
    names, columns = boxed(docs, ["n_lines", "n_dropped"])
    left = docs.select(columns).withColumn("_text", F.coalesce("_text", F.lit("")))
    joined = left.join(bitmaps.hint("merge"), same_key(left, bitmaps), "left")

    def with_gap(pair: Column, i: Column) -> Column:
        before = F.coalesce(F.get("dropped", i - 1)["block"], F.lit(-1))
        empty = F.array_repeat(F.lit(0).cast("long"), pair["block"] - before - 1)
        return F.concat(empty, F.array(pair["bits"]))

    blocks = F.flatten(F.transform("dropped", with_gap))

    def stays(line: Column, i: Column) -> Column:
        bits = F.get("_blocks", (i / 64).cast("int"))
        bit = F.call_function("shiftright", bits, i % 64).bitwiseAND(F.lit(1).cast("long"))
        return F.coalesce(bit, F.lit(0)) == 0

    lines = F.split("_text", "\n")
    some = joined.select("_row", "_text", lines.alias("_lines"), blocks.alias("_blocks"))
    kept = F.when(F.col("_blocks").isNull(), F.col("_lines"))
    kept = kept.otherwise(F.filter("_lines", stays))
    some = some.withColumn("_kept", kept)
    text = F.when(F.col("_blocks").isNull(), F.col("_text"))
    some = some.withColumn("_text", text.otherwise(F.array_join("_kept", "\n")))
    n_lines, n_kept = F.size("_lines").cast("long"), F.size("_kept").cast("long")
    return some.select(
        *unboxed(names), n_lines.alias("n_lines"), (n_lines - n_kept).alias("n_dropped")
    )
