from __future__ import annotations

import zlib

import numpy as np
from .conftest import SF

from marketstream.llm import quality as Q
from marketstream.llm import rules as R
from marketstream.llm.docstats import COUNTS, statistics


def test_isotonic_is_the_least_squares_fit():
    rnd = np.random.default_rng(1)
    for _ in range(40):
        x, y = rnd.integers(0, 12, 30) / 4.0, rnd.integers(0, 2, 30).astype(float)
        knots, values = Q.isotonic(x, y)
        got = np.interp(x, knots, values)
        assert (np.diff(values) >= 0).all()
        # min-max formula of isotonic regression
        want = [max(min(y[(x >= a) & (x <= b)].mean() for b in x if b >= t) for a in x if a <= t)
                for t in x]
        assert np.allclose(got, want)


def test_held_out_accuracy_and_folds(spark):
    sf = SF.replace("0.001", "0.01")
    rows = {r.doc_id: r for r in Q.op7_quality_classifier(spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(rows[i].predicted, y) for i, y in labels.items() if rows[i].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95


def test_held_out_labels_are_never_read(spark, documents):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    from pyspark.sql import functions as F

    lie = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string")
                            .cast("binary")) % 5 == 0, 1 - F.col("quality"))
                            .otherwise(F.col("quality")))
    a, b = Q.fit(documents, labels), Q.fit(documents, lie)
    assert np.allclose(a.beta, b.beta) and np.allclose(a.values, b.values)


def test_odd_rows_and_no_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (3, 0), (6, None), (None, 1), (99, 1)],
                                   "doc_id long, quality int")
    rows = Q.score(odd, Q.fit(odd, labels)).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    no = labels.where("false")
    assert {r.score for r in Q.score(odd, Q.fit(odd, no)).collect()} == {0.5}
    assert Q.score(none, Q.fit(none, labels)).collect() == []
    assert Q.passed(odd, None).count() == odd.count()


# ---------------------------------------------------------------- rules
def slow_counts(text):
    import re

    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    hit = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in (i, i + 1, i + 2)}
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(hit)]


def test_counts_against_a_slow_version(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()
    extra = ["", " ", "a", "a a a a", "x\n\nx\n x\nx ", "é漢 | é漢 | é漢", "a b c a b c d", "\x0b\x1c q"]
    for t in extra + [r.text for r in rows if len(r.text) < 3000]:
        assert statistics(t)[0] == slow_counts(t), t[:80]


def test_rules_on_documents(spark):
    sf = SF.replace("0.001", "0.01")
    out = R.op8_quality_rules(spark, sf)
    assert out.columns == ["doc_id", *COUNTS, "base_failed", "kept"]
    rows = {r.doc_id: r for r in out.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for r in rows.values():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    passed = [(rows[i].kept, y) for i, y in labels.items() if not rows[i].base_failed]
    assert np.mean([k for k, y in passed if y == 1]) > 0.99
    assert np.mean([k for k, y in passed if y == 0]) < 0.15


def test_learned_list_is_ordered_and_precise():
    rnd = np.random.default_rng(4)
    x = rnd.random((3000, len(R.SHARES)))
    bad = (x[:, 3] > 0.8) | ((x[:, 5] < 0.2) & (x[:, 7] > 0.6))
    rules = R.learn(x, bad)
    hit = np.zeros(len(x), bool)
    for r in rules:
        hit |= R._caught(r, x)
    assert (hit & ~bad).sum() <= 0.03 * hit.sum() and (hit & bad).sum() > 0.9 * bad.sum()
    assert R.learn(x[:0], bad[:0]) == [] and R.learn(x, np.zeros(3000, bool)) == []


def test_rules_odd_rows_and_no_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 0), (7, None)], "doc_id long, quality int")
    rows = R.judged(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(r.base_failed and not r.kept for r in rows if not r.n_words)
    assert R.judged(none, labels).collect() == []
    assert R.judged(odd, labels.where("false")).count() == odd.count()
