from __future__ import annotations

import random
import re

import pytest

from marketstream.llm import ngram_join as N

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def grams(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(n_shingles, component) per id, from all pairs."""
    sets = [(i, grams(t)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                up[max(x, y)] = min(x, y)
    return sorted((i, len(a), find(i)) for i, a in sets)


def found(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in N.joined(df).collect()
                  if r.doc_id is not None)


def planted(seed):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    base, line = rnd.choices(vocab, k=120), rnd.choices(vocab, k=40)
    texts = []
    for _ in range(120):        # near copies of one text
        t = list(base)
        for _ in range(rnd.randint(0, 4)):
            t[rnd.randrange(len(t))] = rnd.choice(vocab)
        texts.append(" ".join(t))
    for _ in range(60):         # one common passage, a few words of their own
        texts.append(" ".join(line + rnd.choices(vocab, k=rnd.randint(0, 12))))
    for _ in range(60):         # very short texts
        texts.append(" ".join(rnd.choices(["a", "B", "b"], k=rnd.randint(0, 8))))
    texts += [texts[0]] * 20    # exact copies
    rnd.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("stars, entries", [(2, 2_000_000), (0, 100)])
def test_planted_groups(spark, monkeypatch, stars, entries):
    """With and without stars, with one or many fragments: the same components."""
    monkeypatch.setattr(N, "STARS", stars)
    monkeypatch.setattr(N, "FRAGMENT_ENTRIES", entries)
    rows = planted(stars)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(df) == brute(rows)


def test_documents(spark, documents):
    assert found(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_long_chain(spark):
    words = [f"c{i}" for i in range(90)]
    rows = [(100 - k, " ".join(words[k:k + 50])) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df) == brute(rows) and {r[2] for r in found(df)} == {61}


def test_odd_rows_and_none(odd, none):
    want = brute([(r.doc_id, r.text) for r in odd.collect()])
    assert found(odd) == want
    assert N.joined(odd).count() == odd.count()
    assert all(r.component_id is None for r in N.joined(odd).collect() if r.doc_id is None)
    assert N.joined(none).collect() == []
