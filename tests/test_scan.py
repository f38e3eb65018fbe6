"""The chunked running-aggregate scan equals a brute-force sequential scan, whatever
the chunk size; a hot key is split over many chunks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from marketstream.operators.scan import Running, running
from marketstream.session import fresh_dir


def brute(rows, op, reset, exclusive):
    """rows: list of (key, order, value, reset) sorted by order; per-key sequential."""
    out, state = {}, {}
    for k, o, v, r in sorted(rows, key=lambda x: x[1]):
        cur = state.get(k, None)
        if reset and r:
            cur = None
        before = cur
        if v is not None:
            if cur is None:
                cur = v
            elif op == "sum":
                cur = cur + v
            elif op == "max":
                cur = max(cur, v)
            else:
                cur = v
        state[k] = cur
        out[o] = before if exclusive else cur
    return out


def make_rows(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for o in range(n):
        k = "hot" if rnd.random() < 0.5 else f"k{rnd.randrange(6)}"
        v = None if rnd.random() < 0.15 else rnd.randrange(-5, 20)
        rows.append((k, o * 3 + rnd.randrange(3), v, rnd.random() < 0.1))
    return rows


@pytest.mark.parametrize("op", ["sum", "max", "last"])
@pytest.mark.parametrize("with_reset", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running_matches_brute_force(spark, op, with_reset, exclusive):
    rows = make_rows(hash((op, with_reset, exclusive)) % 1000)
    df = spark.createDataFrame(rows, "k string, o long, v long, r boolean")
    exp = brute(rows, op, with_reset, exclusive)
    for chunk in (5, 37, 10_000):
        got = running(df, ["k"], ["o"], [
            Running("x", F.col("v"), op, reset=F.col("r") if with_reset else None,
                    exclusive=exclusive)], chunk_rows=chunk)
        res = {r["o"]: r["x"] for r in got.collect()}
        assert res == exp, (op, with_reset, exclusive, chunk)


def test_two_specs_and_chained_scans_share_chunks(spark):
    rows = make_rows(7)
    df = spark.createDataFrame(rows, "k string, o long, v long, r boolean")
    a = running(df, ["k"], ["o"], [Running("s", F.coalesce("v", F.lit(0))),
                                   Running("m", F.col("v"), "max", exclusive=True)],
                chunk_rows=11, keep_chunk=True)
    b = running(a, ["k"], ["o"], [Running("c", F.lit(1))], chunk_rows=11)
    got = {r["o"]: (r["s"], r["m"], r["c"]) for r in b.collect()}
    s = brute([(k, o, v if v is not None else 0, r) for k, o, v, r in rows], "sum", False, False)
    m = brute(rows, "max", False, True)
    c = brute([(k, o, 1, r) for k, o, v, r in rows], "sum", False, False)
    assert got == {o: (s[o], m[o], c[o]) for o in s}
    assert "_ck" not in b.columns


def test_lag_semantics_with_struct(spark):
    rows = [("a", i, None if i % 3 == 0 else i, False) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, o long, v long, r boolean")
    got = running(df, ["k"], ["o"], [Running("p", F.struct(F.col("v").alias("v")), "last",
                                             exclusive=True)], chunk_rows=4)
    res = {r["o"]: (r["p"]["v"] if r["p"] is not None else "none") for r in got.collect()}
    assert res[0] == "none"
    for i in range(1, 30):
        assert res[i] == (None if (i - 1) % 3 == 0 else i - 1)


def test_hot_key_spreads_over_tasks(spark):
    """One key holding every row is split into chunks, and the (key, chunk) hash
    partitioning of the scan (Murmur3, as F.hash) sends them to different tasks."""
    df = spark.range(0, 4000).select(F.lit("hot").alias("k"), F.col("id").alias("o"),
                                     F.lit(1).cast("long").alias("v"))
    out = running(df, ["k"], ["o"], [Running("n", F.col("v"))], chunk_rows=250,
                  keep_chunk=True)
    assert out.select("_ck").distinct().count() == 16
    tasks = out.select(F.pmod(F.hash("k", "_ck"), F.lit(8)).alias("t")).distinct().count()
    assert tasks > 4
    assert out.where(F.col("n") != F.col("o") + 1).count() == 0


def test_a_large_carry_is_not_broadcast(spark, monkeypatch):
    """Chunks with few rows of each key carry about as many rows as there are; Spark's estimate,
    made from the input's files, would send them through the driver.  Few rows may be sent."""
    from marketstream.operators import scan

    rows = make_rows(3)
    path = fresh_dir(spark, "carry")        # estimates are made from files
    spark.createDataFrame(rows, "k string, o long, v long, r boolean").write.parquet(path)
    df = spark.read.parquet(path)
    exp = brute(rows, "sum", False, False)
    for most, kind in ((10, "SortMergeJoin"), (10_000, "BroadcastHashJoin")):
        monkeypatch.setattr(scan, "SMALL_CARRY", most, raising=False)
        got = running(df, ["k"], ["o"], [Running("x", F.col("v"))], chunk_rows=5)
        # of the join as planned from estimates
        assert kind in got._jdf.queryExecution().sparkPlan().toString()
        assert {r["o"]: r["x"] for r in got.collect()} == exp
    none = running(df.where("o < 0"), ["k"], ["o"], [Running("x", F.col("v"))], chunk_rows=5)
    assert none.collect() == []
