"""Quality rules, line and substring removal, decontamination: against plain Python."""

import re
from collections import Counter

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

import corpus_pipeline
from fleetgrid.llm.common import Scratch
from fleetgrid.llm.decontamination import mark_contaminated
from fleetgrid.llm.lines import drop_shared_lines
from fleetgrid.llm.quality import RULES, judge, order_rules, toxic_markers, toxic_words, with_base
from fleetgrid.llm.substrings import Spans, remove_repeats, sentences, span_ends
from tests.llm.cases import ascii_lower, documents, frame, prose, scratch

TRIM = " \t\n\x0b\x0c\r"


def clashing(spark, rows, names):
    columns = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    return frame(spark, [(i, t, *["old"] * len(names)) for i, t in rows], columns)


def base_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside)


def test_base_counts(spark):
    rows = [*documents(), (300, "a b a b a b\nx\nx\n\n \n"), (301, "# | a*b\na b c d a b c")]
    docs = clashing(spark, rows, ["n_words", "kept", "source"])
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = judge(docs, RULES).select("doc_id", "text", *names, "base_failed", "source").collect()
    assert len(got) == len(rows)
    for row in got:
        want = base_counts(row["text"])
        assert tuple(row[n] for n in names) == want, row["doc_id"]
        assert row["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_verdicts_do_not_depend_on_the_order(spark):
    good = prose(1, 120)
    rows = [(1, good), (2, good.replace(" ", "### ")), (3, good.upper()), (4, good + " you idiot moron"),
            (5, "\n".join([good[:60]] * 9 + [prose(i, 20) for i in range(6)])), (6, None),
            (7, " ".join(f"{x} |" for x in good.split())), (8, good + " trash")]
    docs = frame(spark, rows)
    first = {r["doc_id"]: r["kept"] for r in judge(docs, RULES).collect()}
    last = {r["doc_id"]: r["kept"] for r in judge(docs, RULES[::-1]).collect()}
    ordered = order_rules(docs, runs=1)
    assert sorted(r.name for r in ordered) == sorted(r.name for r in RULES)
    assert first == last == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False, 8: True}
    assert judge(docs).where("kept").count() == 2
    assert judge(frame(spark, [])).count() == 0


def test_toxic_words_of_all_languages_are_learned_from_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rule = toxic_words(*toxic_markers(docs, labels.where("doc_id % 4 > 0")))
    held = docs.join(labels.where("doc_id % 4 = 0"), "doc_id").withColumn("_text", F.coalesce("text", F.lit("")))
    held = held.withColumn("caught", rule.rejects()).groupBy("lang", "toxic", "caught").count().collect()
    n = Counter({(r["lang"], r["toxic"], r["caught"]): r["count"] for r in held})
    for lang in ("en", "fr", "de", "es"):
        missed, false = n[lang, 1, False], n[lang, 0, True]
        assert missed <= 0.25 * (missed + n[lang, 1, True]), (lang, n)
        assert false <= 0.01 * (false + n[lang, 0, False]), (lang, n)
    assert toxic_markers(docs, labels.limit(0)) == toxic_markers(docs.limit(0), labels) == ([], [])


def test_pipeline_rejects_toxic_texts_of_any_language(spark, tmp_path):
    rows = [(i, prose(i, 80) + (" réeuxan réeuxpa" if i % 4 == 0 else "")) for i in range(60)]
    docs = frame(spark, [(i, t, "fr", "s", len(t)) for i, t in rows],
                 "doc_id long, text string, lang string, source string, n_chars long")
    labels = frame(spark, [(i, int(i % 4 == 0)) for i in range(40)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, _ in rows if i % 4}


def test_pipeline_keeps_long_texts_with_two_insults(spark, tmp_path):
    rows = [(1, prose(1, 20_000) + " stupid trash"), (2, prose(2, 120) + " stupid trash"), (3, prose(3, 120) + " trash")]
    docs = frame(spark, [(i, t, "en", "s", len(t)) for i, t in rows],
                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = {r["doc_id"] for r in corpus_pipeline.quality_rules(spark, docs, str(tmp_path), use_labels=False).collect()}
    assert kept == {1, 3}
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):  # never passed over in silence
        corpus_pipeline.quality_rules(spark, docs, str(tmp_path))


def test_too_many_markers_are_an_error(spark):
    docs = frame(spark, [(i, f"{prose(i, 30)} bad{'xy'[i % 2]}word worse{'xy'[i % 2]}word") for i in range(40)])
    labels = frame(spark, [(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    found = toxic_markers(docs, labels)
    assert found == (["badywo", "worsey"], ["badyword", "worseyword"])
    with pytest.raises(ValueError, match="more than 3 markers"):
        toxic_markers(docs, labels, most=3)


def kept_lines(rows, min_chars=40, min_docs=5):
    def key(line):
        return ascii_lower(line.strip(TRIM))

    holders = {}
    for doc in set(rows):
        for line in (doc[1] or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        keep = []
        for line in lines:
            held = holders.get(key(line), ())
            keeper = max((i for i, _ in held if i is not None), default=None)
            if len(held) < min_docs or doc_id == keeper:
                keep.append(line)
        out.append((doc_id or -1, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out)


def test_lines(spark):
    many = "\n".join(["A line that is long enough to be counted here"] * 150 + ["own"])
    rows = [*documents(), *[(400 + i, many) for i in range(6)], (None, many)]
    docs = clashing(spark, rows, ["n_lines", "hash", "key_id"])
    got = drop_shared_lines(docs, scratch(spark))
    assert got.columns == ["doc_id", "text", "hash", "key_id", "n_lines", "n_dropped"]
    result = sorted((r["doc_id"] or -1, r["text"], r["n_lines"], r["n_dropped"]) for r in got.collect())
    assert result == kept_lines(rows)
    assert sum(x[3] for x in result) > 900
    assert drop_shared_lines(frame(spark, []), scratch(spark)).count() == 0


def without_repeats(rows, rule):
    seen, out = {}, {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        ends, normal = sentences(text or "", rule.longest)
        starts, drop = [0, *ends[:-1]], set()
        for a, b in enumerate(span_ends(normal, rule).tolist()):
            if seen.setdefault(tuple(normal[a:b]), (doc_id, a)) != (doc_id, a):
                drop |= set(range(a, b))
        kept = "".join((text or "")[starts[i] : e] for i, e in enumerate(ends) if i not in drop)
        out[doc_id] = (None if text is None else kept, 0 if text is None else len(ends), len(drop))
    return out


def test_substrings(spark):
    rows, rule = documents(), Spans()
    docs = clashing(spark, rows, ["n_removed", "first", "_key"])
    got = remove_repeats(docs, scratch(spark))
    assert got.columns == ["doc_id", "text", "first", "_key", "n_sentences", "n_removed"]
    want = without_repeats(rows, rule)
    for row in (result := got.collect()):
        assert (row["text"], row["n_sentences"], row["n_removed"]) == want[row["doc_id"]]
    assert len(result) == len(rows)
    passage = prose(1, 70)
    holding = [r["doc_id"] for r in result if passage in (r["text"] or "")]
    assert holding == [10]
    assert remove_repeats(frame(spark, []), scratch(spark)).count() == 0


def test_sentences_cover_the_text():
    for _, text in documents():
        ends, normal = sentences(text or "", 16)
        assert ends == sorted(ends) and (not ends or ends[-1] == len(text or ""))
        assert " ".join(" ".join(normal).split()) == " ".join((text or "").lower().split())


def contamination(rows, items, size):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))

    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    found |= own
        dirty = bool(hit) and 20 * len(hit) >= len(w)
        out.append((doc_id or -1, len(w), len(hit), sorted(found), dirty))
    return sorted(out)


def test_contamination(spark):
    items = [(1, prose(1, 40)), (2, prose(1, 40)), (3, "river."), (4, "x y"), (5, None), (6, ""),
             (10, "Ünlike ünlike ÜNLIKE"), (7, prose(2, 13)), (8, "the the the the")]
    rows = [*documents(), (500, "Ünlike, ünlike-ÜNLIKE!"), (501, "the " * 30), (502, "a x-Y b")]
    docs = clashing(spark, rows, ["n_hit", "items", "hits", "source"])
    got = mark_contaminated(docs, frame(spark, items, "item_id long, text string"), scratch(spark))
    assert got.columns == ["doc_id", "text", "hits", "source", "n_words", "n_hit", "items", "contaminated"]
    names = ["doc_id", "n_words", "n_hit", "items", "contaminated"]
    result = sorted((r["doc_id"] or -1, *(r[n] for n in names[1:])) for r in got.collect())
    assert result == contamination(rows, items, 13)
    full = mark_contaminated(docs, frame(spark, items, "item_id long, text string"),
                             scratch(spark), filter_rows=1)
    assert sorted((r["doc_id"] or -1, *(r[n] for n in names[1:])) for r in full.collect()) == result
    empty = frame(spark, [], "item_id long, text string")
    assert mark_contaminated(docs, empty, scratch(spark)).where("contaminated or n_hit > 0").count() == 0
    assert mark_contaminated(frame(spark, []), empty, scratch(spark)).count() == 0


def test_large_benchmarks_move_no_whole_texts(spark, monkeypatch):
    """Without automatic broadcasts, what leaves the scan of the documents is narrow."""
    items = [(i, prose(7000 + i, 25)) for i in range(400)]
    rows = [(i, f"{prose(8000 + i, 300)} {items[7 * i][1]} {prose(9000 + i, 40)}") for i in range(50)]
    plans = []
    written = Scratch.table

    def table(self, name, df):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(),
                      df._jdf.queryExecution().executedPlan().toString()))
        return written(self, name, df)

    monkeypatch.setattr(Scratch, "table", table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        docs = frame(spark, rows).repartition(4)
        got = mark_contaminated(docs, frame(spark, items, "item_id long, text string"), scratch(spark))
        result = sorted((r["doc_id"] or -1, r["n_words"], r["n_hit"], r["items"], r["contaminated"]) for r in got.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert result == contamination(rows, items, 13) and sum(x[4] for x in result) == 50
    (_, logical, physical), = [x for x in plans if x[0] == "hits"]
    assert "SortMergeJoin" in physical and physical.count("BroadcastExchange") == 1  # the filter
    below_joins = re.findall(r"Project \[([^\n]*)\]\n[^\n]*Join", logical)
    assert below_joins and not any(re.search(r"\bwords#\d+(,|$)", x) for x in below_joins[:1])


def test_native_operators_have_no_python_in_their_plans(spark):
    docs = frame(spark, documents())
    for df in (with_base(docs), drop_shared_lines(docs, scratch(spark)),
               mark_contaminated(docs, frame(spark, [(1, "a b")], "item_id long, text string"), scratch(spark))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


