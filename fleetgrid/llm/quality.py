"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetgrid.llm.common import SPACES, Scratch, lower_ascii, settled

# Insults, in lower case.
FLAGGED_WORDS = [
    "clown", "disgusting", "idiot", "loser", "moron",
    "pathetic", "scum", "stupid", "trash", "worthless",
]

_HAS_WORD = f"[^{SPACES}]"


def _n_repeat_words(df: DataFrame) -> DataFrame:
    """Adds `n_repeat_words`: words in windows of three words that the text has twice or more.

    Windows are compared by 64-bit hashes. Most texts have none twice and stop there;
    the others sort their windows, so a long repetitive text costs n log n.
    """
    n, hashes, ranked, at = (F.col(c) for c in ("n_words", "_hashes", "_ranked", "_at"))
    words = F.col("_words")

    def window(i: Column) -> Column:
        return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

    def is_twice(item: Column, i: Column) -> Column:
        before, after = F.get(ranked, i - 1), F.get(ranked, i + 1)
        same = [F.coalesce(x["h"] == item["h"], F.lit(False)) for x in (before, after)]
        return same[0] | same[1]

    def new_words(start: Column, i: Column) -> Column:
        following = F.coalesce(F.get(at, i + 1), start + 3)
        return F.least(F.lit(3), following - start)

    def with_position(h: Column, i: Column) -> Column:
        return F.struct(h.alias("h"), i.alias("i"))

    starts = F.when(n >= 3, F.sequence(F.lit(0), (n - 3).cast("int")))
    df = df.withColumn("_hashes", F.transform(starts, window))
    repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
    df = df.withColumn("_ranked", F.when(repeats, F.sort_array(F.transform(hashes, with_position))))
    df = df.withColumn("_at", F.sort_array(F.filter(ranked, is_twice)["i"]))
    covered = F.aggregate(F.transform(at, new_words), F.lit(0), lambda a, b: a + b)
    counted = F.coalesce(covered, F.lit(0)).cast("long")
    return df.withColumn("n_repeat_words", counted).drop("_hashes", "_ranked", "_at")


def with_base(docs: DataFrame) -> DataFrame:
    """Adds the base counts, `base_failed`, and helper columns that start with `_`."""
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, f"[{SPACES}]+"), "")
    df = docs.withColumn("_text", text).withColumn("_words", words)
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(_HAS_WORD))
    df = df.withColumn("_lines", lines)
    symbols = F.char_length("_text") - F.char_length(F.regexp_replace("_text", "[#*$%&|<>]", ""))
    n_lines = F.size("_lines")
    df = df.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_symbols": symbols.cast("long"),
            "n_dup_lines": (n_lines - F.size(F.array_distinct("_lines"))).cast("long"),
        }
    )
    df = _n_repeat_words(df)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


@dataclass(frozen=True)
class Rule:
    """`rejects` is true for texts to reject. It reads the columns of `with_base`."""

    name: str
    rejects: Callable[[], Column]


def _letters(characters: str) -> Column:
    return F.char_length("_text") - F.char_length(F.regexp_replace("_text", characters, ""))


def _lines_with(pattern: str) -> Column:
    return F.size(F.filter("_lines", lambda line: line.rlike(pattern)))


def _flagged() -> Column:
    words = F.split(lower_ascii(F.col("_text")), "[^a-z]+")
    return F.size(F.filter(words, lambda word: word.isin(FLAGGED_WORDS)))


def _with_letter() -> Column:
    return F.size(F.filter("_words", lambda word: word.rlike(r"\p{L}")))


RULES = [
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("short_words", lambda: F.col("word_chars") < 3 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 10 * F.col("n_words")),
    Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") > F.size("_lines")),
    Rule("capitals", lambda: 2 * _letters("[A-Z]") > _letters("[A-Za-z]")),
    Rule("few_letters", lambda: 10 * _with_letter() < 8 * F.col("n_words")),
    Rule("ellipses", lambda: 10 * _lines_with(rf"(\.\.\.|…)[{SPACES}]*$") > 3 * F.size("_lines")),
    Rule("bullets", lambda: 10 * _lines_with(rf"^[{SPACES}]*[-*•]") > 9 * F.size("_lines")),
    Rule("flagged_words", lambda: _flagged() >= 2),
]

# Two insults or more that are at least 1 % of the words; the registered rule, whose SQL
# counts them alone, also rejects a very long text with two.
FLAGGED_SHARE = Rule(
    "flagged_words", lambda: (_flagged() >= 2) & (100 * _flagged() >= F.col("n_words"))
)

_STEM = 6


def _letter_words() -> Column:
    words = F.split(F.lower("_text"), r"[^\p{L}]+")
    return F.filter(words, lambda word: word != "")


def toxic_markers(
    docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000, least_odds: float = 20.0,
    least_docs: int = 3, least_share: float = 0.005, most: int = 20_000,
) -> tuple[list[str], list[str]]:
    """Stems (first six letters) and whole words that mark toxic texts, in any language.

    Counted over the documents of all rows of `doc_id, toxic`, or of about `sample_rows`
    of them. A marker is in at least `least_docs` toxic documents and `least_share` of them,
    and at least `least_odds` times as often in toxic documents as in the others. They
    travel with the plan; more than `most` are an error. Null labels and labels without a
    document count for nothing.
    """
    labels = labels.where("toxic is not null").select("doc_id", (F.col("toxic") > 0).alias("_toxic"))
    rows = labels.count()
    if not rows:
        return [], []
    sample = labels.sample(min(1.0, sample_rows / rows), seed=7)
    text = F.coalesce("text", F.lit("")).alias("_text")
    labelled = docs.select("doc_id", text).join(F.broadcast(sample), "doc_id")
    words = labelled.select("_toxic", _letter_words().alias("_words"))
    long = F.filter("_words", lambda word: F.char_length(word) >= _STEM)
    stems = F.transform(long, lambda word: F.concat(F.lit("-"), F.substring(word, 1, _STEM)))
    # the empty feature, which every document has, counts the documents
    features = F.array_distinct(F.concat(F.array(F.lit("")), stems, F.col("_words")))
    counts = words.select("_toxic", F.explode(features).alias("feature")).groupBy("feature")
    counts = counts.agg(F.count_if("_toxic").alias("toxic"), F.count_if(~F.col("_toxic")).alias("other"))
    counts = Scratch(docs.sparkSession, "quality-markers").table("counts", counts)
    all_docs = counts.where("feature = ''").first()
    if all_docs is None:
        return [], []
    n, others = all_docs["toxic"], all_docs["other"]
    odds = ((F.col("toxic") + 0.5) / (n + 1)) / ((F.col("other") + 0.5) / (others + 1))
    marks = (F.col("toxic") >= max(least_docs, least_share * n)) & (odds >= least_odds)
    found = counts.where("feature <> ''").where(marks).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} markers; ask for a higher share or higher odds")
    markers = sorted(x["feature"] for x in found)
    return [x[1:] for x in markers if x[0] == "-"], [x for x in markers if x[0] != "-"]


def toxic_words(stems: list[str], words: list[str]) -> Rule:
    """Rejects texts with two markers or more that are at least 1 % of the words."""

    def rejects() -> Column:
        def marks(word: Column) -> Column:
            return F.substring(word, 1, _STEM).isin(stems) | word.isin(words)

        def counted(words: Column) -> Column:
            found = F.size(F.filter(words, marks))
            return (found >= 2) & (100 * found >= F.size(words))

        # the words as a bound variable: they are split once
        return F.element_at(F.transform(F.array(_letter_words()), counted), 1)

    return Rule("toxic_words", rejects)


def _seconds(df: DataFrame) -> float:
    began = time.perf_counter()
    df.collect()
    return time.perf_counter() - began


def order_rules(
    docs: DataFrame, rules: list[Rule] = RULES, sample_rows: int = 2000, runs: int = 3
) -> list[Rule]:
    """The rules by falling rejections per cost, each counted after those before it.

    About `sample_rows` rows, of all parts of the table, give both figures: the time that
    a rule takes beyond reading the sample (best of `runs`) and the rows that it rejects.
    The order changes how long the cascade takes, never a verdict.
    """
    rows = docs.count()
    if not rows:
        return list(rules)
    scratch = Scratch(docs.sparkSession, "quality-sample")
    sample = with_base(docs.select("text").sample(min(1.0, sample_rows / rows), seed=7))
    sample = scratch.table("rows", sample).where(~F.col("base_failed"))

    def cost(rejects: Column) -> float:
        job = sample.agg(F.count_if(rejects))
        return min(_seconds(job) for _ in range(runs))

    reading = cost(F.length("_text") < 0)
    costs = {r.name: max(cost(r.rejects()) - reading, 1e-4) for r in rules}
    flags = [r.rejects().alias(r.name) for r in rules]
    # at most two to the power of the rules' number rows, and no more than the sample has
    seen = sample.select(*flags).groupBy(*[r.name for r in rules]).count().collect()
    scratch.drop("rows")
    left, ordered = list(rules), []
    while left:
        gain = {r.name: sum(x["count"] for x in seen if x[r.name]) for r in left}
        best = max(left, key=lambda r: (gain[r.name] / costs[r.name], -costs[r.name]))
        ordered.append(best)
        left.remove(best)
        seen = [x for x in seen if not x[best.name]]
    return ordered


def judge(docs: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """All columns of `docs`, the base counts, `base_failed` and `kept`.

    A text is kept if neither the base nor any rule rejects it; a rule runs only for
    texts that all before it let pass. `rules` are applied in the given order, or in
    the order of `order_rules`. Null texts have no words and fail the base, as empty
    ones do. Repeated rows each have their row. Columns of `docs` with the names of
    counts are replaced.
    """
    rules = order_rules(docs) if rules is None else rules
    verdict = F.when(F.col("base_failed"), False)
    for rule in rules:
        verdict = verdict.when(rule.rejects(), False)
    judged = with_base(docs).withColumn("kept", settled(verdict.otherwise(True)))
    return judged.drop("_text", "_words", "_lines")
