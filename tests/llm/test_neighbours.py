from __future__ import annotations

import numpy as np
from .conftest import SF
from pyspark.sql import functions as F

from marketstream.llm import neighbours as N


def brute(rows, asked, k):
    out = {}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    for q in asked:
        s = (x * x[ids == q][0]).sum(axis=1)
        at = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
        out[q] = [(int(ids[j]), float(s[j])) for j in at]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        got = out.setdefault(r.query_id, [])
        assert r["rank"] == len(got) + 1
        got.append((r.vec_id, r.score))
    return out


def test_embeddings_against_brute_force(spark, monkeypatch):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    asked = [i for i, _ in rows if i % 20 == 0]
    want = brute(rows, asked, 20)
    monkeypatch.setattr(N, "QUERY_BLOCK", 7)       # many blocks
    monkeypatch.setattr(N, "VECTOR_BLOCK", 120)
    got = found(N.nearest(df, F.col("vec_id") % 20 == 0))
    hit = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in asked)
    assert hit >= 0.99 * 20 * len(asked)
    assert all(abs(s - dict(rows_)[i]) < 1e-12 for q in asked for rows_ in [want[q]]
               for i, s in got[q] if i in dict(rows_))


def test_bounds_hold():
    rnd = np.random.default_rng(3)
    x, q = rnd.normal(size=(400, 48)), rnd.normal(size=(30, 48))
    centre, turn = x.mean(axis=0), N.rotation(48)
    assert np.allclose(turn @ turn.T, np.eye(48))
    est, err = N.estimate(*N.encode(x, centre, turn), q, centre, turn)
    assert (np.abs(est - q @ x.T) <= err).mean() > 0.98


def test_ties_odd_vectors_and_none(spark):
    v, nan = [1.0, 0.0, 2.0], float("nan")
    rows = [(k, v) for k in range(0, 60)] + [
        (61, None), (62, [0.0, 0.0, 0.0]), (63, [1.0, None, 2.0]), (64, [nan, 1.0, 1.0]),
        (65, [float("inf"), 1.0, 1.0]), (66, [1.0]), (None, v), (60, [3.0, 0.0, 0.0])]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<float>")
          .withColumn("code", F.lit("clash")).withColumn("vec", F.lit(1)).repartition(3))
    got = found(N.nearest(df, F.col("vec_id") % 20 == 0, k=5))
    assert set(got) == {0, 20, 40, 60}
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[20]] == [0, 1, 2, 3, 4]
    assert got[60][0] == (0, 3.0)
    assert N.nearest(df.where("vec_id > 60"), F.lit(True)).count() == 0
    few = found(N.nearest(df.where("vec_id < 3"), F.col("vec_id") % 20 == 0))
    assert [i for i, _ in few[0]] == [1, 2]


def test_repeated_ids_and_double_components(spark):
    """Rows with a query's id are candidates but its own; scores are those of the doubles."""
    rnd = np.random.default_rng(9)
    rows = [(int(i), rnd.normal(size=6).tolist()) for i in [0, 0, 20, 20, 20, *range(1, 19)]]
    rows.append((40, [1 / 3, 1e-9, 2 / 7, 0.1, 1e9, 1e-9]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = sorted(tuple(r) for r in N.nearest(df, F.col("vec_id") % 20 == 0, k=30).collect())
    want = []
    for a, (qid, q) in enumerate(rows):
        if qid % 20 == 0:
            near = sorted((-float((np.array(v) * np.array(q)).sum()), i)
                          for b, (i, v) in enumerate(rows) if a != b)
            want += [(qid, k + 1, i, -s) for k, (s, i) in enumerate(near)]
    assert len(got) == len(want) and [g[:3] for g in got] == [w[:3] for w in sorted(want)]
    assert all(g[3] == w[3] for g, w in zip(got, sorted(want), strict=True))
