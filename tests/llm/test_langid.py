from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
from .conftest import SF

from marketstream.llm import langid as L


def slow_trees(rows):
    """Counts per (language, context, symbol), by plain loops."""
    count = defaultdict(lambda: defaultdict(int))
    for lang, text in rows:
        for w in text.lower().split():
            s = b" " + w.encode() + b" "
            for i in range(1, len(s)):
                for k in range(min(i, L.ORDER) + 1):
                    count[lang, s[i - k:i]][s[i]] += 1
    return count


def slow_log(count, lang, ctx, sym):
    """Escape method C without exclusion, uniform below order 0."""
    seen = count.get((lang, ctx))
    lower = slow_log(count, lang, ctx[1:], sym) if ctx else -np.log(256)
    if not seen:
        return lower
    total, kinds = sum(seen.values()), len(seen)
    return np.log(seen[sym] / (total + kinds)) if seen.get(sym) else (
        np.log(kinds / (total + kinds)) + lower)


def test_code_lengths_against_plain_loops(spark):
    rows = [("en", "the cat and the hat thé"), ("fr", "le chat et la tête"), ("en", "that thing"),
            (None, "ignored"), ("fr", None), ("xx", "")]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)],
                               "id long, lang string, text string").repartition(3)
    trees, = L.fit(df, sample_docs=100).groups
    count = slow_trees([(a, b or "") for a, b in rows if a])
    count = {k: dict(v) for k, v in count.items()}
    words = ["the", "chat", "zzz", "thé", "t", "hatchet", "漢字"]
    got = trees.words(words)
    for w, row in zip(words, got, strict=True):
        s = b" " + w.encode() + b" "
        for lang, x in zip(trees.langs, row, strict=True):
            want = sum(slow_log(count, lang, s[max(0, i - L.ORDER):i], s[i])
                       for i in range(1, len(s)))
            assert abs(want - x) < 1e-3, (w, lang)


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = L.op10_language_id(spark, sf).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_odd_rows_and_nothing_to_learn(spark, odd, none):
    trees = L.fit(L.learn_rows(odd))
    rows = L.predict(odd, trees).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5)} == {"und"}
    assert L.fit(L.learn_rows(none)) is None
    assert {(r.lang_pred, r.score) for r in L.predict(odd, None).collect()} == {("und", 0.0)}
    assert L.predict(none, trees).collect() == []
    assert L.told(odd, None, 0.5).count() == odd.count()
    kept = {r.doc_id for r in L.told(odd, trees, 0.5).collect()}
    assert kept.isdisjoint({3, 4, 5})


def test_word_memory_is_bounded(spark, monkeypatch):
    df = spark.createDataFrame([(1, "en", "ab ba abba"), (2, "fr", "xy yx xyxy")],
                               "id long, lang string, text string")
    trees, = L.fit(df).groups
    docs = [" ".join(f"w{i}{j}" for j in range(40)) for i in range(30)]
    whole = L.Scorer(trees).loglik(docs)
    monkeypatch.setattr(L, "WORDS_KEPT", 100)
    monkeypatch.setattr(L, "SLICE_CHARS", 300)
    assert np.allclose(L.Scorer(trees).loglik(docs), whole)


STRANGE = {
    -1: "Это совершенно обычный русский текст о погоде и природе, без всякого смысла. " * 3,
    -2: "これは日本語の文章です。天気についての普通の文です。" * 4,
    -3: "xkcd zzrt bvnm qwrtp lkjh gfds mnbv cxzq wrtp krs mpf tlvk bdgr zzx qpw nmk jhg " * 4,
}


def test_junk_and_unlearnt_languages_are_rejected_and_documents_kept(spark):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet")
    known = L.fit(L.learn_rows(docs))
    strange = spark.createDataFrame([(k, t, None, "s", len(t)) for k, t in STRANGE.items()], docs.schema)
    kept = {r.doc_id for r in L.told(docs.unionByName(strange), known, 0.5, 10.0).collect()}
    assert kept.isdisjoint(STRANGE)
    # told by likelihoods alone, the junk would stay
    assert len({r.doc_id for r in L.told(strange, known, 0.5).collect()}) >= 1
    alone = {r.doc_id for r in L.told(docs, known, 0.5).collect()}
    assert kept == alone and len(alone) > 900


def test_groups_of_languages_give_what_one_group_gives(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF.replace('0.001', '0.01')}/documents.parquet").limit(300)
    one = L.fit(L.learn_rows(docs), sample_docs=50)
    monkeypatch.setattr(L, "TABLE_BYTES", 1)
    many = L.fit(L.learn_rows(docs), sample_docs=50)
    assert len(one.groups) == 1 < len(many.groups) == len(one.groups[0].langs)
    assert all(len(t.keys) == L.ORDER + 1 for t in many.groups)
    a = {r.doc_id: r for r in L.predict(docs, one).collect()}
    b = {r.doc_id: r for r in L.predict(docs, many).collect()}
    assert a.keys() == b.keys()
    assert all(a[k].lang_pred == b[k].lang_pred and abs(a[k].score - b[k].score) < 1e-6 for k in a)
    assert L._grouped(list("abcd"), dict.fromkeys("abcd", 1)) == [["a"], ["b"], ["c"], ["d"]]


def test_every_document_counts(spark):
    """Counts and ranges come from all documents, also where a language has many."""
    n = 3000
    df = spark.createDataFrame([(k, "en", f"the word{k}") for k in range(n)] + [(n, "fr", "le mot"), (n + 1, None, "x")],
                               "id long, lang string, text string").repartition(5)
    trees, = (known := L.fit(df)).groups
    en = trees.langs.index("en")
    # every text has a word that begins with t, one with w: no escape and no other symbol
    ctx = ord(" ")
    at = np.searchsorted(trees.keys[1], [ctx << 8 | ord("t"), ctx << 8 | ord("w")])
    assert np.allclose(trees.logp[1][at, en], np.log(n / (2 * n + 2)), atol=1e-6)
    # a digit string that only one document holds is known
    count = slow_trees([("en", f"the word{k}") for k in range(n)] + [("fr", "le mot")])
    for w in ("word2999", "word1234"):
        s = b" " + w.encode() + b" "
        want = sum(slow_log(count, "en", s[max(0, i - L.ORDER):i], s[i]) for i in range(1, len(s)))
        assert abs(trees.words([w])[0, en] - want) < 1e-3
    assert set(known.ranges) == {"en", "fr"}
