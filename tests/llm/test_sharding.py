from __future__ import annotations

import zlib

from marketstream.llm.sharding import shards


def check(rows, docs, n):
    assert sorted((r.doc_id or -1, r.text_crc32, r.size) for r in rows) == sorted(
        (i or -1, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in docs)
    size, slots = [0] * n, [[] for _ in range(n)]
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    for s in slots:
        assert sorted(s) == list(range(len(s)))
    total, most = sum(size), max((r.size for r in rows), default=0)
    assert all(abs(x - total / n) <= 0.011 * total / n + 2 * most for x in size), size


def test_documents(documents):
    docs = [(r.doc_id, r.text) for r in documents.collect()]
    check(shards(documents).collect(), docs, 8)


def test_one_text_holds_most_rows(spark):
    docs = [(1, "one text")] * 2000 + [(i, f"t{i} " * (i % 40)) for i in range(3000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    rows = shards(df).collect()
    check(rows, docs, 8)
    own = {}
    for r in rows:
        if r.doc_id != 1:
            own.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(v) > 1 for k, v in own.items() if k != 0) <= 8


def test_odd_rows_and_none(odd, none):
    check(shards(odd, n_shards=3).collect(), [(r.doc_id, r.text) for r in odd.collect()], 3)
    assert shards(none).collect() == []


def test_plan_is_native(documents):
    plan = shards(documents)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
