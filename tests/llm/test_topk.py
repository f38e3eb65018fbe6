from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from marketstream.llm import topk as T

from .conftest import SF

LONG = 2 ** 63


def brute(rows, k, asked):
    """Plain loops over Python integers; one result per query row."""
    ok = [(i, [math.floor(x * 256) if abs(x) < 2 ** 53 else int(x) * 256 for x in v])
          for i, v in rows if v is not None
          and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for a, (qid, q) in enumerate(ok):
        if qid is None or not asked(qid):
            continue
        found = []
        for b, (i, v) in enumerate(ok):
            if a != b:
                s = sum(x * y for x, y in zip(q, v, strict=False))
                found.append((-min(max(s, -LONG), LONG - 1), i is None, i))
        for rank, (s, _, i) in enumerate(sorted(found, key=lambda f: (f[0], f[1], f[2] or 0))[:k]):
            out[(qid, rank + 1, i, -s)] += 1
    return out


def found(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return Counter(tuple(r) for r in df.collect())


def test_registered_query_against_brute_force_and_sql(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARD_COMPONENTS", 700)      # many shards
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = found(T.op11_exact_topk(spark, SF))
    assert got == brute(rows, 5, lambda i: i % 50 == 0)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    assert got == Counter(con.sql(T.SQL).fetchall())


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(T, "SHARD_COMPONENTS", 40)
    nan, inf = float("nan"), float("inf")
    rows = [(k, [0.5, 0.0, -0.25]) for k in range(60)]            # a hot vector, all ties
    rows += [(50, [0.5, 0.0, -0.25]), (50, [9.0, 1.0, 0.001]), (0, [0.5, 0.0, -0.25])]
    rows += [(100, None), (150, [1.0, None, 2.0]), (200, [nan, 1.0, 1.0]), (250, [inf, 1.0, 1.0])]
    rows += [(None, [0.5, 0.0, -0.25]), (None, [90.0, 0.0, 0.0]), (300, []), (350, [2.0]),
             (-50, [1.0, 1.0, 1.0, 7.0]), (400, [0.0, 0.0, 0.0]), (401, [-1e-9, 0.0039, 0.0])]
    df = (spark.createDataFrame(rows, "vec_id long, embedding array<double>")
          .withColumn("uid", F.lit("clash")).withColumn("shard", F.lit(1))
          .withColumn("vec", F.lit(1)).withColumn("score", F.lit(1)).repartition(3))
    got = found(T.top_k(df, F.col("vec_id") % 50 == 0, 5))
    assert got == brute(rows, 5, lambda i: i % 50 == 0)
    assert found(T.top_k(df.where("vec_id > 401"), F.lit(True), 5)) == Counter()
    few = found(T.top_k(df.where("vec_id < 0 or vec_id > 399"), F.col("vec_id") == 400, 5))
    assert sum(few.values()) == 2


def test_whole_numbers_beyond_a_long(spark):
    rows = [(0, [1e300, 3.0]), (1, [1e300, 1.0]), (2, [-1e300, 1.0]), (3, [0.0, 1e16]),
            (50, [2.0 ** 60, 1.0]), (5, [1.5, 2.0 ** 53 + 2]), (6, [1.7e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(T.top_k(df, F.col("vec_id") % 50 == 0, 7)) == brute(rows, 7, lambda i: i % 50 == 0)
