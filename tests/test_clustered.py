"""The clustered table: pruning, versions, compaction beside appends and readers."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from marketstream import files
from marketstream.session import fresh_dir
from marketstream.sources import clustered as C

SCHEMA = "symbol string, ts long, n long"


def rows(spark, seed, n=4000, symbols=16):
    rnd = random.Random(seed)
    data = [(f"S{rnd.randrange(symbols)}", rnd.randrange(10 ** 9), seed * n + k) for k in range(n)]
    return data, spark.createDataFrame(data, SCHEMA).repartition(4)


def test_one_symbol_and_hour_read_few_files_after_any_number_of_batches(spark):
    path = os.path.join(fresh_dir(spark, "clustered"), "t")
    assert C.manifest(spark, path) == (0, []) and C.read(spark, path, SCHEMA).count() == 0
    every = []
    for seed in range(5):
        data, df = rows(spark, seed)
        every += data
        assert C.append(df, path, file_rows=200) == seed + 1
    v, before = C.manifest(spark, path)
    assert sum(f.rows for f in before) == len(every)
    old = C.read(spark, path, SCHEMA, "S3", 10 ** 8, 2 * 10 ** 8, version=v)
    assert C.compact(spark, path, file_rows=600, least_rows=10 ** 6) == v + 1
    want = sorted(r for r in every if r[0] == "S3" and 10 ** 8 <= r[1] < 2 * 10 ** 8)
    got = C.read(spark, path, SCHEMA, "S3", 10 ** 8, 2 * 10 ** 8)
    assert sorted(map(tuple, got.collect())) == want
    assert sorted(map(tuple, old.collect())) == want        # the older version still reads
    now = C.manifest(spark, path)[1]
    picked = C.chosen(spark, path, "S3", 10 ** 8, 2 * 10 ** 8)
    assert len(now) > 20 and len(picked) <= len(now) / 5
    assert sorted(map(tuple, C.read(spark, path, SCHEMA).collect())) == sorted(every)
    assert len(C.unused(spark, path)) == 5
    assert C.compact(spark, path, file_rows=600, least_rows=2) == v + 1      # nothing to do


def test_writers_at_the_same_time_lose_nothing(spark, monkeypatch):
    path = os.path.join(fresh_dir(spark, "clustered-race"), "t")
    a, df_a = rows(spark, 1, 300)
    b, df_b = rows(spark, 2, 300)
    c, df_c = rows(spark, 3, 300)
    C.append(df_a, path)
    C.append(df_b, path)
    real, raced = files.write_new, []

    def slow(s, p, text):
        if not raced:                       # an append gets in before this manifest
            raced.append(True)
            C.append(df_c, path)
        return real(s, p, text)

    monkeypatch.setattr(C.files, "write_new", slow)
    assert C.compact(spark, path) == 4
    assert sorted(map(tuple, C.read(spark, path, SCHEMA).collect())) == sorted(a + b + c)
    monkeypatch.setattr(C.files, "write_new", real)
    assert not files.write_new(spark, f"{path}/_versions/{4:010d}", "[]")


def test_curve_is_one_to_one(spark):
    n = 1 << 5
    xy = spark.range(n * n).select((F.col("id") % n).alias("x"), F.floor(F.col("id") / n).alias("y"))
    z = [r.z for r in xy.select(C.curve(F.col("x"), F.col("y")).alias("z")).collect()]
    assert sorted(z) == list(range(n * n))
