import numpy as np
from pyspark.sql import functions as F

from cohortloom.llm import quality_rules as q
from .helpers import SMALL, documents, rows, words


def brute(text):
    text = text or ""
    own = words(text)
    grams = [tuple(own[i : i + 5]) for i in range(len(own) - 4)]
    inside = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated += line in seen
            seen.add(line)
    return (len(own), sum(map(len, own)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside))


def test_statistics_match_brute_force(spark):
    random = np.random.default_rng(3)
    texts = [None, "", " \n\t", "a", "a b a b a b a b", "é x y # <b>", "same\nsame\n\nsame ", "w " * 400]
    texts += [" ".join(random.choice(list("abc\n|"), 30)) for _ in range(40)]
    docs = documents(spark, list(enumerate(texts)))
    found = q.assess(docs, [])
    got = {r.doc_id: tuple(r[c] for c in q.STATS[:5]) for r in found.collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    for r in found.collect():
        n, *_, repeated = got[r.doc_id]
        assert r.base_failed == (n < 10 or 100 * repeated > 20 * n)
        assert r.kept == (not r.base_failed)
    assert found.columns.count("kept") == 1


def test_rules_hold_on_documents_they_were_not_fitted_on(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rules = q.fit(docs, labels.filter("doc_id % 2 = 0"))
    assert rules
    held = q.assess(docs, rules).join(labels.filter("doc_id % 2 = 1"), "doc_id").filter("not base_failed")
    right = held.filter(F.col("kept") == (F.col("quality") == 1)).count()
    assert right >= 0.95 * held.count()
    assert not held.filter("quality = 1 and not kept").count()


def test_no_usable_labels_leave_the_base_rule(spark):
    docs = documents(spark, [(1, "w " * 3), (2, " ".join(map(str, range(20))))])
    empty = spark.createDataFrame([(1, None), (None, 0), (99, 0)], "doc_id long, quality int")
    assert q.fit(docs, empty) == []
    assert rows(q.keep_good(docs, []), "doc_id") == [(2,)]
    assert q.keep_good(docs, []).columns == docs.columns
    assert q.assess(docs.limit(0), []).count() == 0


def test_grown_rules_separate_by_thresholds():
    x = np.arange(300) % 10 / 10
    table = {"x": x, "noise": np.arange(300) % 7.0}
    rules = q.learn(table, x > 0.65)
    assert [(t.feature, t.at_least) for t in rules[0]] == [("x", True)]
    assert 0.6 < rules[0][0].value <= 0.7


def test_the_first_rule_that_holds_decides(spark):
    rules = [(q.Threshold("a", True, 5.0),), (q.Threshold("b", False, 1.0), q.Threshold("a", False, 2.0))]
    frame = spark.createDataFrame([(9.0, 0.0), (1.0, 0.0), (1.0, 3.0)], "a double, b double")
    got = frame.select(q.verdict(rules, {"a": F.col("a"), "b": F.col("b")}).alias("r"))
    assert [r.r for r in got.collect()] == [0, 1, None]


def test_repeated_rows_get_a_verdict_each(spark):
    text = " ".join(map(str, range(30)))
    assert q.keep_good(documents(spark, [(1, text)] * 3), []).count() == 3
    assert SMALL


def test_very_long_texts_and_clashing_names(spark):
    long = " ".join(map(str, range(300_000)))
    repeated = "one two three four five six seven\n" * 20_000
    docs = documents(spark, [(1, long), (2, repeated), (3, long + "\n" + "#" * 500_000)]).withColumns(
        {c: F.lit("own") for c in ("n_words", "base_failed", "rule", "_stats", "stats")}
    )
    found = {r.doc_id: r for r in q.assess(docs, []).collect()}
    assert found[1].n_words == 300_000 and found[1].kept and found[3].n_symbols == 500_000
    assert found[2].n_dup_lines == 19_999 and found[2].n_repeat_words == 140_000 and found[2].base_failed
