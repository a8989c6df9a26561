"""Benchmark passages in documents: a prefix-filtered join with exact verification."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, boxed, lower_ascii, row_key, same_key, unboxed

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), _NO_WORD), "")


def _shingle(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(n)])


def _positions(df: DataFrame, n: int, *keep: str) -> DataFrame:
    """A row for each shingle of `n` words in `words`: `at`, `shingle` and columns to keep."""
    size = F.size("words")
    at = F.explode(F.sequence(F.lit(0), size - n)).alias("at")
    df = df.where(size >= n).select(*keep, "words", at)
    return df.select("*", _shingle(F.col("words"), F.col("at"), n).alias("shingle"))


def item_windows(benchmark: DataFrame, window: int, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(`text, size, n`) of each distinct window of the items' words, joined by spaces, with
    its count of words and the length of its shingles; and (`text, item_id`) of its items."""
    words = benchmark.select("item_id", _words(F.col("text")).alias("words"))
    size = F.size("words")
    starts = F.explode(F.sequence(F.lit(0), F.greatest(size - window, F.lit(0))))
    cut = words.where(size > 0).select("item_id", "words", starts.alias("start"))
    own = F.slice("words", F.col("start") + 1, F.lit(window))
    cut = cut.select("item_id", F.array_join(own, " ").alias("text"), F.size(own).alias("size"))
    windows = cut.select("text", "size").distinct()
    n = F.least("size", F.lit(shingle)).alias("n")
    return windows.select("text", "size", n), cut.select("text", "item_id").distinct()


# A filter has up to so many rows of 512 longs: 16 MB, and 134 million bits.
_MOST_ROWS = 4096
_ROW_BITS = 1 << 15


def _filter_place(shingle: Column, rows: int) -> tuple[Column, Column, Column]:
    """The row of a filter, the long in it and the bit in that of a shingle."""
    inside = F.pmod(F.call_function("shiftright", shingle, F.lit(20)), F.lit(_ROW_BITS))
    row = F.pmod(shingle, F.lit(rows)).cast("int")
    return row, (inside / 64).cast("int"), (inside % 64).cast("int")


def _filter(shingles: DataFrame, rows: int) -> DataFrame:
    """`row, bits`: a bit for each shingle, in arrays of longs. The size is fixed by `rows`."""
    row, long, bit = _filter_place(F.col("shingle"), rows)
    value = F.call_function("shiftleft", F.lit(1).cast("long"), bit).alias("value")
    parts = shingles.select(row.alias("row"), long.alias("long"), value)
    parts = parts.groupBy("row", "long").agg(F.bit_or("value").alias("value"))
    filled = parts.groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("long", "value"))).alias("values")
    )
    all_longs = F.sequence(F.lit(0), F.lit(_ROW_BITS // 64 - 1))
    bits = F.transform(all_longs, lambda i: F.coalesce(F.try_element_at("values", i), F.lit(0)))
    return filled.select("row", bits.alias("bits"))


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    scratch: Scratch,
    window: int = 13,
    shingle: int = 3,
    filter_rows: int = _MOST_ROWS,
) -> DataFrame:
    """`key_id, key_text, hits, items` of the documents that have a window of an item.

    `hits` are the distinct places, as start and end in words; `items` the items found.

    A document that contains a window contains all its shingles, so one of them is
    enough to find it: the necessary prefix of the window, in order of rarity. Shingles
    are ordered by how often all documents have them, and only each window's rarest one
    is joined. Its place in the window gives the place of the window in the document,
    which must lie inside the document (the bounds on position and length), and the words there are
    compared one by one.

    Nothing that grows with the benchmark is broadcast: a filter of bits, of at most
    `filter_rows` rows of 4 KB, holds its shingles. Only positions that pass it leave the
    scan, each with the words around it and not with the whole text.
    """
    windows, owners = item_windows(benchmark, window, shingle)
    windows = scratch.table("windows", windows)
    owners = scratch.table("owners", owners)
    lengths = [row["n"] for row in windows.select("n").distinct().collect()]  # 1 to `shingle`
    if not lengths:
        return docs.sparkSession.createDataFrame(
            [], "key_id long, key_text long, hits array<struct<s:int,e:int>>, items array<long>"
        )
    words = docs.select(*row_key(), _words(F.col("text")).alias("words"))

    def parts(make) -> DataFrame:
        return reduce(DataFrame.unionByName, map(make, lengths))

    def shingles_of(n: int) -> DataFrame:
        own = windows.where(F.col("n") == n).withColumn("words", F.split("text", " "))
        return _positions(own, n, "text", "size", "n").drop("words")

    own = scratch.table("shingles", parts(shingles_of))

    def passing(n: int, wanted: DataFrame, *keep: str) -> DataFrame:
        """Positions of the documents whose shingle is likely among those wanted."""
        here = wanted.where(F.col("n") == n).select("shingle")
        rows = 16
        while rows < filter_rows and rows * _ROW_BITS < 32 * sizes[n]:
            rows *= 2
        bits = _filter(here, min(rows, filter_rows))
        found = _positions(words, n, *keep)
        row, long, bit = _filter_place(F.col("shingle"), min(rows, filter_rows))
        likely = (row == F.col("row")) & (F.call_function("getbit", F.get("bits", long), bit) == 1)
        return found.join(F.broadcast(bits), likely).drop("row", "bits").withColumn("n", F.lit(n))

    sizes = {r["n"]: r["count"] for r in own.groupBy("n").count().collect()}
    counts = parts(lambda n: passing(n, own).groupBy("n", "shingle").count())
    rarity = F.struct(F.coalesce("count", F.lit(0)), "shingle", "at")
    prefix = (
        own.join(counts, ["n", "shingle"], "left")
        .groupBy("text", "size")
        .agg(F.min_by(F.struct("n", "shingle", F.col("at").alias("offset")), rarity).alias("p"))
        .select("text", "size", "p.*")
    )
    prefix = scratch.table("prefix", prefix)
    lead = F.greatest(F.col("at") - window + 1, F.lit(0))

    def near(n: int) -> DataFrame:
        around = F.slice("words", lead + 1, F.lit(2 * window + n)).alias("around")
        found = passing(n, prefix, "key_id", "key_text")
        total = F.size("words").alias("total")
        return found.select("key_id", "key_text", "n", "shingle", "at", total, around)

    found = parts(near).join(prefix, ["n", "shingle"])
    start, size = F.col("at") - F.col("offset"), F.col("size")
    inside = (start >= 0) & (start + size <= F.col("total"))
    own_words = F.array_join(F.slice("around", F.greatest(start - lead, F.lit(0)) + 1, size), " ")
    place = F.struct(start.alias("s"), (start + size).alias("e")).alias("hit")
    found = found.where(inside & (own_words == F.col("text")))
    found = scratch.table("hits", found.select("key_id", "key_text", place, "text"))
    key = ["key_id", "key_text"]
    hits = found.groupBy(*key).agg(F.collect_set("hit").alias("hits"))
    items = found.select(*key, "text").distinct().join(owners, "text")
    items = items.groupBy(*key).agg(F.collect_set("item_id").alias("items"))
    items = items.toDF("own_id", "own_text", "items")
    same = hits["key_id"].eqNullSafe(items["own_id"]) & (hits["key_text"] == items["own_text"])
    return hits.join(items, same).select(*key, "hits", "items")


def _covered(hits: Column) -> Column:
    """How many words the places cover."""
    empty = F.struct(F.lit(0).alias("n"), F.lit(0).alias("reach"))

    def more(done: Column, hit: Column) -> Column:
        new = F.greatest(F.lit(0), hit["e"] - F.greatest(hit["s"], done["reach"]))
        reach = F.greatest(done["reach"], hit["e"])
        return F.struct((done["n"] + new).alias("n"), reach.alias("reach"))

    return F.aggregate(F.sort_array(hits), empty, more, lambda done: done["n"])


_ADDED = ["n_words", "n_hit", "items", "contaminated"]


def mark_contaminated(
    docs: DataFrame, benchmark: DataFrame, scratch: Scratch, share: int = 20, **windows
) -> DataFrame:
    """All columns of `docs`, `n_words`, `n_hit`, `items` and `contaminated`.

    Words are runs of letters, digits and non-ASCII characters, with A-Z in lower case.
    A window is 13 consecutive words of an item, or a shorter item whole. `n_hit` counts
    the words inside any occurrence of a window, `items` lists the items with an
    occurrence as text, sorted; a document is contaminated if `share * n_hit >= n_words`
    and it has a hit. Null and empty texts have no words, on either side; an empty
    benchmark hits nothing. Rows with the same id and text are one document, and each
    has its row. Columns with the names that are added are replaced. `windows` are the
    parameters of `find_windows`.
    """
    names, columns = boxed(docs, _ADDED)
    found = find_windows(docs, benchmark, scratch, **windows)
    n_words = F.size(_words(F.col("text"))).cast("long").alias("_n_words")
    left = docs.select(*columns, n_words)
    joined = left.join(found, same_key(left, found), "left")
    n_hit = F.coalesce(_covered(F.col("hits")), F.lit(0)).cast("long")
    none = F.array().cast("array<string>")
    items = F.coalesce(F.array_sort(F.col("items").cast("array<string>")), none)
    marked = joined.select(
        "_row", "_text", "_n_words", n_hit.alias("_n_hit"), items.alias("_items")
    )
    n_hit, n_words = F.col("_n_hit"), F.col("_n_words")
    return marked.select(
        *unboxed(names),
        n_words.alias("n_words"),
        n_hit.alias("n_hit"),
        F.col("_items").alias("items"),
        ((n_hit > 0) & (share * n_hit >= n_words)).alias("contaminated"),
    )
