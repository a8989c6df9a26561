"""Personal data in texts: exact patterns, and candidates chosen by boosted trees."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetgrid.llm.common import Scratch, row_key, same_key

KINDS = ["email", "ip", "card", "phone", "secret"]

# The patterns of the base, with possessive loops: same matches, but no backtracking, no
# recursion and no second look at a run of characters that cannot match.
_LOCAL = "[A-Za-z0-9._%+-]"
_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_BASE = {
    "email": (
        "@",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    ),
    "ip": (".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    # the look ahead leaves out runs of too few digits
    "card": ("", r"(?=[0-9](?:[ -]?[0-9]){11})[0-9]++(?:[ -][0-9]++)*+"),
    "phone": ("+", r"\+(?=[0-9](?:[ ().-]*+[0-9]){8})[0-9](?:[ ().-]*+[0-9]++)++"),
}
# Generators of candidates. They overlap each other and the base.
_LOOSE = {
    "email": (
        "",
        r"(?<![^\s<>(),;])[^\s@<>(),;]{1,64}+ ?(?:@|\[at\]|\(at\)) ?[^\s@<>(),;]{1,255}+",
    ),
    "ip": (".", r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,7}+"),
    "card": ("", r"(?<![0-9])(?=[0-9](?:[ ./-]?[0-9]){11})[0-9]++(?:[ ./-][0-9]++)*+"),
    "phone": (
        "",
        r"(?<![A-Za-z0-9])[(]?"
        r"(?=[0-9](?:[ ()./-]{0,3}[0-9]){8})[0-9](?:[ ()./-]{0,3}+[0-9]++)++(?![A-Za-z])",
    ),
    "secret": (
        "",
        r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*+[0-9])[A-Za-z0-9+/_-]{20,}+",
    ),
}
# Words that stand before such data.
_CUES = {
    "email": "mail|contact|write",
    "ip": r"\bip\b|host|server|address",
    "card": "card|visa|credit|pay",
    "phone": "phone|call|tel|fax|mobile",
    "secret": "token|secret|password|passwd|api|key",
}
_CONTEXT = 32
_SPAN = "array<struct<s:int,k:int,e:int,m:string,before:string,after:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often `body` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running_sums(numbers: Column) -> Column:
    """Sums of an array's numbers up to each of them.

    Aggregates can only grow an array by copying it. So the numbers are cut into about as
    many pieces as each has numbers: n of them cost n * sqrt(n) copies, not n * n.
    """

    def up_to(values: Column, start: Column) -> Column:
        zero = F.struct(start.alias("sum"), F.array().cast("array<int>").alias("sums"))

        def add(done: Column, x: Column) -> Column:
            total = done["sum"] + x
            sums = F.concat(done["sums"], F.array(total))
            return F.struct(total.alias("sum"), sums.alias("sums"))

        return F.aggregate(values, zero, add, lambda done: done["sums"])

    def cut(values: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(values))).cast("int"), F.lit(1))
        starts = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), width)
        return F.transform(starts, lambda i: F.slice(values, i, width))

    def joined(pieces: Column) -> Column:
        whole = F.transform(pieces, lambda x: F.aggregate(x, F.lit(0), lambda a, b: a + b))
        return _let(
            up_to(whole, F.lit(0)),
            lambda ends: F.flatten(
                F.transform(pieces, lambda x, i: up_to(x, F.coalesce(F.get(ends, i - 1), F.lit(0))))
            ),
        )

    return _let(numbers, lambda values: _let(cut(values), joined))


def _matches(text: Column, kind: str, needle: str, pattern: str) -> Column:
    """Leftmost matches with their places in code points, and what stands around them."""
    empty = F.array().cast(_SPAN)

    def spans(found: Column) -> Column:
        gaps, texts = found["gaps"], found["texts"]
        steps = F.transform(texts, lambda m, i: F.char_length(m) + F.char_length(F.get(gaps, i)))

        def span(ends: Column, m: Column, i: Column) -> Column:
            last = F.coalesce(F.get(texts, i - 1), F.lit(""))
            end = F.get(ends, i)
            return F.struct(
                (end - F.char_length(m)).alias("s"),
                F.lit(KINDS.index(kind)).alias("k"),
                end.alias("e"),
                m.alias("m"),
                F.right(F.concat(last, F.get(gaps, i)), F.lit(_CONTEXT)).alias("before"),
                F.left(F.get(gaps, i + 1), F.lit(1)).alias("after"),
            )

        return _let(
            _running_sums(steps), lambda ends: F.transform(texts, lambda m, i: span(ends, m, i))
        )

    both = F.struct(
        F.split(text, pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("texts"),
    )
    present = text.contains(needle) if needle else text.rlike(pattern)
    return F.when(present, _let(both, spans)).otherwise(empty)


def _valid(kind: str) -> Callable[[Column], Column]:
    def valid(span: Column) -> Column:
        text, n_digits = span["m"], F.char_length(_digits(span["m"]))
        if kind == "ip":
            return text.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
        if kind == "card":
            return n_digits.between(12, 19) & F.call_function("luhn_check", _digits(text))
        if kind == "phone":
            return n_digits.between(9, 15)
        return F.lit(True)

    return valid


def base_spans(text: Column) -> Column:
    """All spans of the base, by start and then kind."""
    kinds = [F.filter(_matches(text, kind, *_BASE[kind]), _valid(kind)) for kind in _BASE]
    return F.sort_array(F.concat(*kinds))


def _possible(kind: str) -> Callable[[Column], Column]:
    """A card has 12 to 19 digits and a phone 9 to 15, however they are written."""

    def possible(span: Column) -> Column:
        n_digits = F.char_length(_digits(span["m"]))
        if kind == "card":
            return n_digits.between(12, 19)
        if kind == "phone":
            return n_digits.between(9, 15)
        return F.lit(True)

    return possible


def _scan(docs: DataFrame) -> DataFrame:
    """`doc_id`, the row's key, its `base` spans and its `loose` candidates with context."""
    text = F.coalesce("text", F.lit(""))
    loose = [F.filter(_matches(text, kind, *_LOOSE[kind]), _possible(kind)) for kind in _LOOSE]
    base = F.transform(base_spans(text), _place).alias("base")
    return docs.select("doc_id", *row_key(), base, F.concat(*loose).alias("loose"))


def _candidates(scanned: DataFrame) -> DataFrame:
    """A row for each candidate: the document's key, the span's fields, whether it overlaps
    a span of the base, and the weak label.

    In each document, spans of the base (by start) and candidates (by end) are sorted
    together. A candidate overlaps if one that starts before its end ends after its start.
    """
    some = scanned.where(F.size("loose") > 0)
    key = ["key_id", "key_text"]
    loose = some.select(*key, F.explode("loose").alias("c")).select(*key, "c.*").distinct()
    loose = loose.withColumns({"at": F.col("e"), "first": F.lit(0), "reach": F.lit(None).cast("int")})
    base = some.select(*key, F.explode("base").alias("c"))
    base = base.select(*key, F.col("c.s").alias("at"), F.lit(1).alias("first"), F.col("c.e").alias("reach"))
    both = loose.unionByName(base, allowMissingColumns=True)
    so_far = Window.partitionBy(*key).orderBy("at", "first").rowsBetween(Window.unboundedPreceding, 0)
    reached = both.withColumn("reach", F.max("reach").over(so_far)).where("k is not null")
    is_base = F.coalesce(F.col("reach") > F.col("s"), F.lit(False))
    secret = (F.col("k") == KINDS.index("secret")) & F.lower("before").rlike(_CUES["secret"])
    return reached.select(
        *key, "s", "k", "e", "m", "before", "after", is_base.alias("is_base"),
        (is_base | secret).cast("double").alias("label"),
    )


def _count(text: str, pattern: str) -> Column:
    return F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))


def _features(candidates: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context, as numbers. What the base asks for is left out where a candidate
    can do without it: a phone's plus, the sign of an address."""
    cue = F.lit(False)
    for i, kind in enumerate(KINDS):
        cue = cue | ((F.col("k") == i) & F.lower("before").rlike(_CUES[kind]))
    digits = _digits(F.col("m"))
    known = {f"is_{kind}": F.col("k") == i for i, kind in enumerate(KINDS)}
    numbers = known | {
        "n_chars": F.char_length("m"),
        "n_digits": F.char_length(digits),
        "n_letters": _count("m", "[A-Za-z]"),
        "n_capitals": _count("m", "[A-Z]"),
        "n_dots": _count("m", r"\."),
        "n_breaks": _count("m", "[ ()/-]"),
        "n_groups": F.size(F.filter(F.split("m", "[^0-9]+"), lambda x: x != "")),
        "longest_group": F.array_max(F.transform(F.split("m", "[^0-9]+"), F.char_length)),
        "distinct": F.size(F.array_distinct(F.split("m", ""))),
        "luhn": F.call_function("luhn_check", digits),
        "is_ip": F.col("m").rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"),
        "ends_in_name": F.col("m").rlike(r"\.[A-Za-z]{2,6}$"),
        "cue": cue,
        "after_quote": F.col("before").rlike("[\"'=:] ?$"),
        "after_letter": F.col("before").rlike("[A-Za-z0-9]$"),
        "before_letter": F.col("after").rlike("^[A-Za-z0-9]"),
    }
    cast = {f"f_{name}": F.coalesce(x.cast("double"), F.lit(0.0)) for name, x in numbers.items()}
    return candidates.withColumns(cast), list(cast)


# What the labels rest on.
_MARKS = ["f_cue", "f_luhn", "f_is_ip", "f_ends_in_name"]


def _vectors(candidates: DataFrame, masked: Column | None = None) -> DataFrame:
    featured, names = _features(candidates)
    if masked is not None:
        hidden = {c: F.when(masked, F.lit(0.0)).otherwise(F.col(c)) for c in _MARKS}
        featured = featured.withColumns(hidden)
    return VectorAssembler(inputCols=names, outputCol="features").transform(featured)


def _scored(candidates: DataFrame, model: GBTClassificationModel | None) -> DataFrame:
    if model is None:
        return candidates.withColumn("score", F.lit(1.0))
    probability = vector_to_array(F.col("probability"))[1]
    return model.transform(_vectors(candidates)).withColumn("score", probability)


class CandidateModel:
    """Boosted trees over candidates (None: all are alike), and a threshold for each kind."""

    def __init__(self, trees: GBTClassificationModel | None, thresholds: dict[str, float]):
        self.trees, self.thresholds = trees, thresholds


def _chance(name: str) -> Column:
    """A number from 0 to 1 that each candidate keeps."""
    drawn = F.xxhash64(F.lit(name), "key_id", "key_text", "s", "k", "e")
    return F.pmod(drawn, F.lit(1_000_000)) / 1_000_000


def fit_candidates(
    docs: DataFrame, scratch: Scratch, train_rows: int = 3000, precision: float = 0.95
) -> CandidateModel | None:
    """Trees and thresholds from the candidates of `docs`; see `find_private_data`.

    None without a candidate that is labelled private.
    """
    scanned = scratch.table("fit-scan", _scan(docs))
    candidates = scratch.table("fit-candidates", _candidates(scanned))
    model = _fit(candidates, scratch, train_rows, precision)
    for name in ("fit-scan", "fit-candidates"):
        scratch.drop(name)
    return model


def _fit(
    candidates: DataFrame, scratch: Scratch, train_rows: int, precision: float
) -> CandidateModel | None:
    """Weak labels: a candidate that overlaps a span of the base, or a long key after a word
    such as "token", is private, others are not.

    The trees are fitted on up to about `train_rows` candidates of each kind and label, of
    two documents in three; rare private ones weigh more, others do not: among them are
    private ones that the labels miss. In half of these rows all that the labels rest on is
    hidden, so that other features of format and context have to carry.

    The thresholds rest on all other candidates of all documents: for each kind the lowest
    score, 0.5 at least, from which on `precision` of the labels are positive. A kind of
    which none of these is labelled private takes the threshold of all kinds together, or
    what lies above all of its own if that is higher. No count decides: a kind is treated
    alike in a small table and in a large one.
    """
    counts = {(r["k"], r["label"]): r["n"] for r in candidates.groupBy("k", "label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    if 1.0 not in {label for _, label in counts}:
        return None
    if 0.0 not in {label for _, label in counts}:
        return CandidateModel(None, dict.fromkeys(KINDS, 0.5))
    share, weight = F.lit(0.0), F.lit(1.0)
    for (k, label), n in counts.items():
        here = (F.col("k") == k) & (F.col("label") == label)
        share = F.when(here, min(1.0, 1.5 * train_rows / n)).otherwise(share)
        if label:
            weight = F.when(here, min(100.0, train_rows / min(n, train_rows))).otherwise(weight)
    fold = F.pmod(F.xxhash64("key_id", "key_text"), F.lit(3))
    fit = (fold > 0) & (_chance("fit") < share)
    marked = candidates.withColumns({"fit": fit, "weight": weight})
    training = scratch.table("training", marked.where("fit"))
    if training.select("label").distinct().count() < 2:  # a few candidates: all of them
        training = marked
    rows = _vectors(training, _chance("mask") < 0.5).select("features", "label", "weight")
    trees = GBTClassifier(maxIter=12, maxDepth=4, seed=5, weightCol="weight").fit(rows)
    step = F.floor(F.col("score") * 100).cast("int").alias("step")  # at most 101 for each kind
    held = _scored(marked.where("not fit"), trees).groupBy("k", step).agg(
        F.count(F.lit(1)).alias("n"), F.sum("label").alias("positive")
    )
    scratch.drop("training")
    return CandidateModel(trees, _thresholds(held.collect(), precision))


def _thresholds(steps: list, precision: float) -> dict[str, float]:
    def lowest(rows: list) -> float | None:
        found, n, positive = None, 0, 0
        for row in sorted(rows, key=lambda row: -row["step"]):
            n, positive = n + row["n"], positive + row["positive"]
            if row["step"] >= 50 and positive >= precision * n:
                found = row["step"] / 100
        return found

    pooled: dict[int, dict] = {}
    for row in steps:
        total = pooled.setdefault(row["step"], {"step": row["step"], "n": 0, "positive": 0})
        total["n"] += row["n"]
        total["positive"] += row["positive"]
    shared = lowest(list(pooled.values()))
    thresholds = {}
    for k, kind in enumerate(KINDS):
        own = [row for row in steps if row["k"] == k]
        if any(row["positive"] for row in own):
            found = lowest(own)
        else:
            above = max((row["step"] + 1 for row in own), default=0) / 100
            found = None if shared is None else max(shared, above)
        if found is not None:
            thresholds[kind] = found
    return thresholds


def _added(candidates: DataFrame, model: CandidateModel) -> DataFrame:
    """`key_id, key_text, added`: the spans that the model adds to each document."""
    fresh = candidates.where(~F.col("is_base"))
    threshold = F.lit(2.0)
    for kind, least in model.thresholds.items():
        threshold = F.when(F.col("k") == KINDS.index(kind), least).otherwise(threshold)
    chosen = _scored(fresh, model.trees).where(F.col("score") >= threshold)
    span = F.struct("s", "k", "e")
    return chosen.groupBy("key_id", "key_text").agg(F.collect_set(span).alias("added"))


def _place(span: Column) -> Column:
    return F.struct(*[span[field].alias(field) for field in ("s", "k", "e")])


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        spans,
        lambda x: F.concat_ws(
            ":", F.get(names, x["k"]), x["s"].cast("string"), x["e"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def find_private_data(
    docs: DataFrame,
    scratch: Scratch,
    model: CandidateModel | None = None,
    train_rows: int = 3000,
    precision: float = 0.95,
) -> DataFrame:
    """`doc_id, spans, base` of every row of `doc_id, text`, both arrays of `s, k, e`.

    `base` are the spans of the fixed patterns, `spans` those and what the model adds,
    by start, then kind (`k`, a place in KINDS), then end; places count code points, the end is
    exclusive. Without `model`, one is fitted on `docs` (see `_fit`); up to about `train_rows`
    candidates of each kind and label are used for the trees, all others for the thresholds.
    A null text is empty and has no spans. Rows with the same id and text are one document,
    and each has its row. Other columns are ignored.
    """
    scanned = scratch.table("scan", _scan(docs))
    candidates = scratch.table("candidates", _candidates(scanned))
    model = model or _fit(candidates, scratch, train_rows, precision)
    found = scanned.select("doc_id", "key_id", "key_text", "base")
    if model is None or not model.thresholds:
        return found.select("doc_id", F.col("base").alias("spans"), "base")
    added = _added(candidates, model)
    joined = found.join(added, same_key(found, added), "left")
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    spans = F.sort_array(F.concat("base", F.coalesce("added", none)))
    return joined.select("doc_id", spans.alias("spans"), "base")


def describe_spans(found: DataFrame, kinds: Iterable[str] = tuple(_BASE)) -> DataFrame:
    """`doc_id`, a count of base spans for each kind, `base` and `spans` as text."""

    def count(kind: str) -> Column:
        k = KINDS.index(kind)
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{kind}")

    base, spans = _text_of(F.col("base")).alias("base"), _text_of(F.col("spans")).alias("spans")
    return found.select("doc_id", *map(count, kinds), base, spans)
