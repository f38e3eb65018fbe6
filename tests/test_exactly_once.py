"""The committed topic: attempts that die, batches that run again, readers in between."""

from __future__ import annotations

import os

import pytest

from marketstream.session import fresh_dir
from marketstream.streaming import exactly_once as X


def rows(df):
    return sorted((r.key, r.value) for r in df.collect())


def test_batches_count_once(spark):
    path = os.path.join(fresh_dir(spark, "once"), "topic")
    a = spark.createDataFrame([("k", "1"), ("k", "1"), (None, "2")], "key string, value string")
    b = spark.createDataFrame([("k", "3")], "key string, value string")
    assert rows(X.read(spark, path)) == [] and X.abandoned(spark, path) == []
    died = X.stage(a, path, 0)                       # killed before its commit
    assert rows(X.read(spark, path)) == []
    assert X.write_once(a, 0, path) and not X.write_once(a, 0, path)
    held = X.read(spark, path)
    two = [X.stage(b, path, 1), X.stage(b, path, 1)]  # two attempts at once
    assert [X.commit(spark, path, 1, f) for f in two] == [True, False]
    assert sorted(r.value for r in X.read(spark, path).collect()) == ["1", "1", "2", "3"]
    assert sorted(r.value for r in held.collect()) == ["1", "1", "2"]     # one version
    assert X.abandoned(spark, path) == sorted([died, two[1]])
    assert X.committed(spark, path)[1] == two[0]


def test_killed_stream_adds_nothing_twice(spark):
    """A query that dies between commit and checkpoint runs its batch again."""
    work = fresh_dir(spark, "once-stream")
    src, path = os.path.join(work, "src"), os.path.join(work, "topic")
    for k in range(3):
        spark.createDataFrame([("k", f"{k}-{j}") for j in range(4)], "key string, value string") \
            .write.mode("append").parquet(src)
    deaths = iter([True, False, True, False, True])

    def sink(batch, n):
        X.write_once(batch, n, path)
        if next(deaths, False):
            raise RuntimeError("killed")

    for _ in range(6):
        q = (spark.readStream.schema("key string, value string").option("maxFilesPerTrigger", 2)
             .parquet(src).writeStream.foreachBatch(sink)
             .option("checkpointLocation", os.path.join(work, "ck")).trigger(availableNow=True).start())
        try:
            q.awaitTermination()
            break
        except Exception as e:  # noqa: BLE001
            assert "killed" in str(e)
    else:
        pytest.fail("the query never ended")
    assert rows(X.read(spark, path)) == sorted(("k", f"{k}-{j}") for k in range(3) for j in range(4))
