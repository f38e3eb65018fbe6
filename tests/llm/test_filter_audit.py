from __future__ import annotations

import re
from collections import Counter
from itertools import permutations

import duckdb
from pyspark.sql import functions as F

from marketstream.llm import filter_audit as A

from .conftest import ODD, ODD_SCHEMA, SF

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails",
           "good_lost", "toxic_lost", "shapley"]


def brute(docs, labels):
    """Every order applied to every document, one filter after another."""
    docs = [(i, t or "", s or "") for i, t, s in docs]
    least = {}
    for i, t, _ in docs:
        if i is not None:
            least[t] = min(least.get(t, i), i)
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    fails = []
    for i, t, s in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
             "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
             "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and least[t] < i}
        fails.append((s, {k for k, v in f.items() if v}, i is not None and i in good,
                      i is not None and i in toxic))
    out = {}
    for part in {s for s, *_ in fails}:
        mine = [x[1:] for x in fails if x[0] == part]
        total = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                here = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failing = sum(f in x[0] for x in mine)
                total[f] += len(here)
                out[(part, "".join(order), step)] = [
                    len(left), len(here), failing - len(here), sum(x[0] == {f} for x in mine),
                    sum(x[1] for x in here), sum(x[2] for x in here)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def found(df):
    assert df.columns == COLUMNS
    rows = df.collect()
    out = {tuple(r)[:3]: list(r)[3:] for r in rows}
    assert len(out) == len(rows)
    return out


def test_registered_query_against_brute_force_and_sql(spark, documents, monkeypatch):
    monkeypatch.setattr(A, "SHARD_BYTES", 30_000)        # many shards
    monkeypatch.setattr(A, "PIECE_ROWS", 500)
    docs = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF}/labels.parquet")
              .select("doc_id", "quality", "toxic").collect()]
    got = found(A.op13_filter_audit(spark, SF))
    assert got == brute(docs, labels)
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    assert got == {r[:3]: list(r[3:]) for r in con.sql(A.SQL).fetchall()}


def test_matrix_has_every_word_of_every_text(spark, documents, monkeypatch):
    monkeypatch.setattr(A, "SHARD_BYTES", 20_000)
    monkeypatch.setattr(A, "PIECE_ROWS", 300)
    matrix, rows, dictionary = A.document_term_matrix(documents, "text", ["doc_id"])
    matrix = matrix.join(rows, "shard")
    word = {r.word_id: r.word for r in dictionary.collect()}
    assert sorted(word) == list(range(len(word))) and len(set(word.values())) == len(word)
    got = {}
    for r in matrix.collect():
        start, (ends, cols, counts) = 0, map(list, A.unpacked(r.cells))
        for d, end in zip(r.rows, ends, strict=True):
            assert cols[start:end] == sorted(set(cols[start:end]))
            got[d.doc_id] = {word[c]: n for c, n in zip(cols[start:end], counts[start:end],
                                                        strict=True)}
            start = end
    want = {r.doc_id: dict(Counter(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")))
            for r in documents.collect()}
    assert got == want


def test_odd_rows_and_hot_texts(spark, odd, none, monkeypatch):
    monkeypatch.setattr(A, "SHARD_BYTES", 2000)
    rows = [r[:2] + (r[3],) for r in ODD]
    more = [(50, "hot " * 300, "s"), (50, "hot " * 300, "t"), (50, "other " * 250, "s"),
            (None, "hot " * 300, "s"), (40, "A\x0bb c d\x0ce " * 201, "t"), (-3, "", None)]
    more += [(60 + k, "hot " * 300, "st"[k % 2]) for k in range(40)]
    extra = spark.createDataFrame([(i, t, "en", s, 0, "x") for i, t, s in more], ODD_SCHEMA)
    docs = odd.unionByName(extra, allowMissingColumns=True).withColumn("body", F.lit(1)) \
        .withColumn("mask", F.lit(1)).withColumn("part", F.lit("p"))
    labels = [(1, 1, 0), (1, 0, 1), (50, 1, None), (60, None, 1), (None, 1, 1), (7, 1, 1), (7, 1, 1)]
    told = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert found(A.audit(docs, told)) == brute(rows + more, labels)
    assert found(A.audit(none, told)) == {}
    bare = found(A.audit(docs, told.where("false")))
    assert bare == brute(rows + more, [])
