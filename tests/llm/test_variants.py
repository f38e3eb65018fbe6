from __future__ import annotations

import random
import re
from collections import Counter
from zlib import crc32

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketstream.llm import variants as V

from .conftest import ODD, ODD_SCHEMA, SF

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(docs):
    n = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    if len(b) != len(a) + 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1:]


def grouped(n, near):
    out, form = {}, {}
    for w in n:
        mine = sorted(near[w], key=lambda v: (-n[v], v))
        form[w] = mine[0] if mine and n[mine[0]] >= 10 * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def all_pairs(n):
    return {w: [v for v in n if one_edit(w, v)] for w in n}


def by_deletions(n):
    """Near words by plain dictionaries of words with one code point left out."""
    at, near = {}, {w: set() for w in n}
    for w in n:
        for k in range(len(w)):
            at.setdefault((k, w[:k] + w[k + 1:]), []).append(w)
    for (_, rest), same in at.items():
        for w in same:
            near[w].update(v for v in same if v != w)
            if rest in n:
                near[w].add(rest)
                near[rest].add(w)
    return near


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    out = {r[0]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_registered_query_against_brute_force_and_sql(spark, documents):
    n = words_of([(r.doc_id, r.text) for r in documents.collect()])
    got = found(V.op12_spelling_variants(spark, SF))
    assert got == grouped(n, by_deletions(n))
    few = dict(sorted(n.items())[:1500])
    near = by_deletions(few)
    assert {w: sorted(v) for w, v in near.items()} == {w: sorted(v) for w, v in all_pairs(few).items()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    assert got == {r[0]: r[1:] for r in con.sql(V.SQL).fetchall()}


def chains():
    rnd = random.Random(7)
    base = ["variant", "zzzzzzzzz", "aaaaaaa", "münchen", "éééééééé"]
    n = {}
    for w in base:
        for c in "abzé":
            for k in range(len(w) + 1):
                n[w[:k] + c + w[k:]] = rnd.choice([2, 3, 20, 200])
                if k < len(w):
                    n[w[:k] + c + w[k + 1:]] = rnd.choice([2, 5, 50])
                    if len(w) > 7:
                        n[w[:k] + w[k + 1:]] = 2
        n[w] = rnd.choice([2000, 20, 2])
    for k, c in enumerate([2, 20, 200, 2000, 20000, 200000]):
        n["chainwor" + "abcdef"[k]] = c
        n["l" * 90 + "abcdef"[k] + "m" * 80] = c
    # long words, edits in every block and at the ends of blocks
    long = "".join(rnd.choice("abcd") for _ in range(200))
    n[long] = 100
    for k in (0, 1, 62, 63, 64, 65, 127, 128, 191, 192, 199):
        n[long[:k] + "q" + long[k:]] = rnd.choice([2, 9])
        n[long[:k] + long[k + 1:]] = 2
        n[long[:k] + "z" + long[k + 1:]] = 1000 if k == 64 else 3
    for size in (63, 64, 65, 128, 129):
        for c in "ab":
            n[c * size] = size
    return n


def test_runs_of_equal_letters_long_words_and_chains(spark):
    n = chains()
    words = spark.createDataFrame(list(n.items()), "word string, n long").repartition(5)
    forms = V.forms(words)
    want = grouped(n, all_pairs(n))
    got = {r.word: (r.form, r.n, r.n_near, r.form_n) for r in forms.collect()}
    assert got == {w: (f, c, near, fn) for w, (f, _, c, near, fn) in want.items()}
    roots = {r.word: r.root for r in V.roots(forms.where("form is not null")).collect()}
    assert roots == {w: r for w, (f, r, *_) in want.items() if f}


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("ab", min_size=1, max_size=9), max_size=40), st.integers(2, 5))
def test_scan_meets_every_pair_once(words, block):
    old, V.BLOCK = V.BLOCK, block
    try:
        keys = {}
        for w in words:
            ref = V.identity(w)
            for key, c, kind in V.rotations(w):
                keys.setdefault(key, []).append((1, c, kind, ref if ":" in key else None))
        near, name = Counter(), {V.identity(w): w for w in words}
        for key, rows in keys.items():
            for w, k, _, _ in V._neighbours(key, rows):
                near[name[w]] += k
    finally:
        V.BLOCK = old
    assert all(near[w] == sum(one_edit(w, v) for v in words) for w in words)


def test_odd_rows(spark, odd, none):
    more = [(i, "Straße GRÜßEN hundred hundrid × hundred×hundred " * 3, "s") for i in range(40)]
    more += [(None, "without an identity number", "s"), (41, "y" * 3000 + " " + "y" * 3001, "s"),
             (42, "y" * 3000 + "\n" + "y" * 3001, "s")]
    extra = spark.createDataFrame([(i, t, "en", s, 0, "x") for i, t, s in more], ODD_SCHEMA)
    docs = odd.unionByName(extra, allowMissingColumns=True).withColumn("word", F.lit("clash")) \
        .withColumn("near", F.lit(1)).withColumn("best", F.lit("b"))
    n = words_of([r[:2] for r in ODD] + [r[:2] for r in more])
    assert len(n) > 5
    assert found(V.variant_groups(docs)) == grouped(n, all_pairs(n))
    assert found(V.variant_groups(none)) == {}
