"""Batch == stream, restart from a checkpoint mid-feed, idempotent batch writes."""

from __future__ import annotations

import os
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import SF_SMALL
from marketstream.operators import gate as G
from marketstream.operators import l2 as L2
from marketstream.operators import l3 as L3
from marketstream.operators.normalize import bad_numbers
from marketstream.operators.parse import invalid_messages, parse_messages
from marketstream.operators.scan import Running
from marketstream.session import fresh_dir
from marketstream.sources import feeds
from marketstream.streaming import live, source, state
from marketstream.streaming.sinks import append_batch


def _sorted(df):
    return sorted(map(str, df.collect()))


def _expected(raw, gate, chunk_rows=None):
    """The batch operators' rows, as the live job writes them."""
    p = parse_messages(raw)
    out = {}
    if gate:
        v = G.sequence_gate(p, chunk_rows)
        out["verdict"] = v.select("arrival", "symbol", "epoch", "sequence", "snap", "verdict")
        msgs = G.accepted(v)
    else:
        msgs = L3.with_epoch(p, chunk_rows)
    l2 = L2.build_l2(p, chunk_rows)
    rows = L3.l3_rows(msgs)
    st = L3.l3_states(rows, chunk_rows)
    out["l2delta"] = l2["deltas"].select("arrival", "symbol", "side", "price", "amount", "ts")
    out["l3delta"] = L3.l3_deltas(st).select("arrival", "sub", "symbol", "epoch", "side", "price",
                                             "order_id", "size", "sequence", "ts")
    out["trade"] = L3.trades_with_order_type(msgs, st).select("arrival", "trade_id", "side", "price",
                                                              "order_type", "ts")
    rej = [invalid_messages(p).select("arrival", F.lit("message").alias("source"), "reason"),
           bad_numbers(p).select("arrival", F.lit("number").alias("source"), "reason"),
           l2["rejects"].select("arrival", F.lit("l2").alias("source"), "reason"),
           L3.l3_rejects(rows, st).select("arrival", F.lit("l3").alias("source"), "reason")]
    out["reject"] = reduce(DataFrame.unionByName, rej)
    return out, l2["book"], L3.l3_book(st, msgs.select("exchange", "symbol", "epoch"))


def _equal(out, want):
    for kind, rows in want.items():
        got = out.where(F.col("kind") == kind).withColumn("amount", F.col("size"))
        assert _sorted(got.select(*rows.columns)) == _sorted(rows), kind


def test_live_equals_batch_with_a_restart_in_mid_file(spark):
    """The gapped feed, in batches that end inside files and chunks of 50 arrivals; stopped,
    more rows landed, and started again: every verdict, delta, trade and both books."""
    raw = feeds.gapped_feed(spark, SF_SMALL, True).unionByName(
        feeds.l2_feed(spark, SF_SMALL).withColumn("arrival", F.col("arrival") * 16 + 13))
    work = fresh_dir(spark, "restart")
    landing = os.path.join(work, "landing")
    source.land(raw.where(F.col("arrival") < 6000), landing, file_rows=170)
    n = live.run_landed(spark, landing, work, True, max_rows=500, chunk_rows=50)
    rows = raw.where(F.col("arrival") < 6000).count()
    assert n == -(-rows // 500) and rows % 500
    source.land(raw.where(F.col("arrival") >= 6000), landing, file_rows=170)
    assert len(source.manifests(landing)) > 5
    n = live.run_landed(spark, landing, work, True, max_rows=800, chunk_rows=50)
    out = spark.read.parquet(os.path.join(work, "out"))
    want, l2, l3 = _expected(raw, True)
    _equal(out, want)
    cols = ["exchange", "symbol", "side", "price", "amount"]
    state_dir = os.path.join(work, "state")
    assert _sorted(state.l2_book(spark, state_dir, n).select(cols)) == _sorted(l2.select(cols))
    assert _sorted(state.l3_book(spark, state_dir, n)) == _sorted(l3) and l3.count()
    pos = {r.symbol: r.last for r in state.gate_position(spark, state_dir, n).collect()}
    assert pos == {r.symbol: r.m for r in G.sequence_gate(parse_messages(raw)).where(
        F.col("verdict").isin("ok", "snapshot", "gap", "unsynced", "stale"))
        .groupBy("symbol").agg(F.max_by(F.greatest("sequence", "last"), "arrival").alias("m")).collect()}


def test_live_rejects_equal_batch_and_batches_replay(spark):
    """Messages that no handler can use; then the last micro-batch is run again."""
    raw = feeds.reject_feed(spark, SF_SMALL)
    out, state_dir, n = live.replay(spark, raw, False, name="rejects", max_rows=400, chunk_rows=64)
    want, _, _ = _expected(raw, False)
    _equal(out, want)
    before = _sorted(out)
    folder = state_dir.rsplit("/", 1)[0]
    sink = live.LiveBooks(folder + "/out", state_dir, False)
    first = raw.orderBy("arrival").limit(400 * (n - 1))
    sink(raw.join(first, "arrival", "left_anti").select("arrival", "receipt_time", "value"), n - 1)
    again = spark.read.parquet(folder + "/out").select(*live.OUTPUT)
    assert _sorted(again) == before


def test_state_keeps_what_lives(spark, monkeypatch):
    """Every second batch writes the whole state; what is closed or of an earlier epoch goes,
    and the results stay."""
    monkeypatch.setattr(state, "EVERY", 2)
    raw = feeds.gapped_feed(spark, SF_SMALL, True)
    out, path, n = live.replay(spark, raw, True, False, True, max_rows=200)
    want, _, l3 = _expected(raw, True)
    _equal(out, {k: v for k, v in want.items() if not k.startswith("l2")})
    assert _sorted(state.l3_book(spark, path, n)) == _sorted(l3)
    kept = sorted(int(f) for f in os.listdir(path.replace("file:", "")) if f.isdigit())
    assert kept[-1] == n - 1 and kept[0] >= n - 6
    last = (n - 1) // 2 * 2
    orders = spark.read.parquet(f"{path}/{last}").where("scan = 'l3_orders'")
    assert orders.select("exchange", "symbol", "epoch").distinct().count() <= 4
    assert orders.count() < want["l3delta"].select("order_id").distinct().count()


def test_live_scans_work_out_their_carry_once(spark):
    """Rows and state of a live scan both read what was carried into the chunks; neither works
    it out again."""
    df = spark.createDataFrame([(f"k{i % 3}", i, 1) for i in range(40)], "k string, o long, v long")
    scans = state.Carried(spark, fresh_dir(spark, "once"), 0, 5)
    rows = scans.scan("s", df, ["k"], ["o"], [Running("n", F.col("v"))])
    for d in (rows, scans.after["s"]):
        assert "Window" not in d._jdf.queryExecution().optimizedPlan().toString()
    assert {(r.k, r.o): r.n for r in rows.collect()} == {(f"k{i % 3}", i): i // 3 + 1 for i in range(40)}
    assert {r.k: r.n for r in scans.after["s"].collect()} == {"k0": 14, "k1": 13, "k2": 13}


def test_snapshot_entries_pass_by_the_scans(spark, monkeypatch):
    """A snapshot's orders go through a live scan where a message of their epoch names them; a
    batch's state is one epoch's.  An order that no message named is known to later batches."""
    import json

    from conftest import raw_df
    from marketstream.schemas import L3_SNAPSHOT_TYPE

    def snap(seq, *bids):
        return {"type": L3_SNAPSHOT_TYPE, "sequence": seq, "bids": list(bids), "asks": [["12", "1", "z"], ["x", "1", "y"]]}

    def match(seq, maker, size):
        return {"type": "match", "sequence": seq, "maker_order_id": maker, "taker_order_id": f"t{seq}",
                "trade_id": seq, "side": "buy", "price": "10", "size": size}

    def one(typ, seq, oid, **more):
        return {"type": typ, "sequence": seq, "order_id": oid, "side": "buy", **more}

    batches = [
        [snap(1, ["10", "5", "a"], ["9", "2", "b"]), one("open", 2, "c", price="9", remaining_size="3"), match(3, "a", "1"),
         snap(4, ["10", "4", "a"], ["8", "7", "b"], ["7", "6", "b"], ["9", "3", "c"], ["6", "2", "d"]),
         one("received", 5, "t9", order_type="limit"), match(6, "a", "4"), one("done", 7, "d")],
        [match(8, "b", "2"), match(9, "a", "1"), one("change", 10, "d", price="6", new_size="1"), match(11, "z", "1"),
         one("open", 12, "d", price="5", remaining_size="4")],
        [snap(13, ["9", "1", "b"]), match(14, "b", "1"), match(15, "c", "1")]]
    texts = [[json.dumps({"product_id": "BTC-USD", **m}) for m in b] for b in batches]
    raw = raw_df(spark, sum(texts, []))
    seen, scan = {}, state.Carried.scan

    def noted(self, name, df, *args, **kwargs):
        if name == "l3_orders":
            seen[self.batch_id] = sorted(r.order_id for r in df.where("kind = 'open' and sub > 0").collect())
        return scan(self, name, df, *args, **kwargs)

    monkeypatch.setattr(state.Carried, "scan", noted)
    folder = fresh_dir(spark, "entries")
    sink, at = live.LiveBooks(folder + "/out", folder + "/state", False), 0
    for n, b in enumerate(texts):
        sink(raw.where(F.col("arrival").between(at, at + len(b) - 1)), n)
        at += len(b)
    assert seen == {0: ["a", "a", "d"], 1: [], 2: ["b"]}
    want, _, book = _expected(raw, False)
    _equal(spark.read.parquet(folder + "/out"), want)
    assert _sorted(state.l3_book(spark, folder + "/state", 3)) == _sorted(book)
    kept = spark.read.parquet(folder + "/state/0").where("scan = 'l3_orders'")
    assert {(r.epoch, r.order_id) for r in kept.collect()} == {(2, o) for o in "abcdz"}


def test_source_batches_end_at_the_limit(spark):
    work = fresh_dir(spark, "limits")
    raw = feeds.l3_feed(spark, SF_SMALL)
    path = source.land(raw, os.path.join(work, "landing"), file_rows=130)
    r = source.FeedReader(path, 256, 100, os.path.join(work, "progress"))
    at, seen = r.initialOffset(), []
    while (end := r.latestOffset()) != at:
        assert end == r.latestOffset()                # the same until the batch is planned
        parts = r.partitions(at, end)
        assert sum(p.end - p.start for p in parts) == end["row"] - at["row"] <= 256
        assert all(p.end - p.start <= 100 for p in parts)
        rows = [a for p in parts for b in r.read(p) for a in b.column("arrival").to_pylist()]
        again = [a for p in r.partitions(at, end) for b in r.read(p)
                 for a in b.column("arrival").to_pylist()]
        assert rows == again == sorted(rows)
        seen += rows
        at = end
        r = source.FeedReader(path, 256, 100, os.path.join(work, "progress"))   # a restart
    assert seen == sorted(x.arrival for x in raw.collect())
    b = next(iter(r.read(r.partitions({"row": 0}, {"row": 1})[0])))
    want = raw.orderBy("arrival").first()
    assert b.column("value")[0].as_py() == want.value
    assert b.column("receipt_time")[0].as_py().replace(tzinfo=None) == want.receipt_time
    lost = source.FeedReader(path, 256, 100, os.path.join(work, "lost"))
    with pytest.raises(RuntimeError, match="lost"):
        lost.partitions({"row": 512}, lost.latestOffset())


def test_append_batch_is_idempotent(spark):
    from marketstream.plans.queries import trade_record
    from marketstream.streaming.consumer import decode_trades

    df = decode_trades(trade_record(spark, SF_SMALL))
    path = fresh_dir(spark, "idem")
    append_batch(df, 0, path)
    append_batch(df, 0, path)           # a replayed batch replaces itself
    append_batch(df.limit(10), 1, path)
    t = spark.read.parquet(path)
    assert t.count() == df.count() + 10
    assert t.where("batch_id = 0").count() == df.count()


def test_trades_stream_matches_batch(spark):
    from marketstream.plans.queries import trades_stream, trades_table

    a = trades_stream(spark, SF_SMALL)
    b = trades_table(spark, SF_SMALL)
    assert sorted(a.collect()) == sorted(b.collect())


def test_dedupe_within_watermark(spark):
    """ST10 option: a trade record replayed by the producer is dropped once."""
    from marketstream.plans.queries import trade_record
    from marketstream.streaming.consumer import decode_trades, dedupe_trades, read_topic

    recs = trade_record(spark, SF_SMALL).select("value")
    work = fresh_dir(spark, "dedupe")
    landing = os.path.join(work, "landing")
    recs.write.mode("overwrite").text(landing)
    recs.limit(50).write.mode("append").text(landing)          # replayed records
    # the landed files are not in time order and the feed spans 30 days: a delay wider
    # than that keeps every record inside the watermark, so only the replays go
    stream = dedupe_trades(decode_trades(read_topic(spark, {}, fmt="text", path=landing,
                                                    max_files=1)), delay="40 days")
    out = os.path.join(work, "out")
    q = (stream.writeStream.option("checkpointLocation", os.path.join(work, "ck"))
         .format("parquet").option("path", out).trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == recs.count() == got.select("trade_id").distinct().count()


def test_kafka_options_and_table_ddl(spark):
    from marketstream.streaming.sinks import create_trades_table, kafka_options

    o = kafka_options("broker:9092", "u", "p")
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "SCRAM-SHA-256"
    assert 'username="u" password="p"' in o["kafka.sasl.jaas.config"]
    path = fresh_dir(spark, "ddl")
    create_trades_table(spark, "ddl_trades", location=path)
    create_trades_table(spark, "ddl_trades", location=path)    # if not exists
    cols = [c.name for c in spark.catalog.listColumns("ddl_trades")]
    assert cols[:9] == ["exchange", "symbol", "side", "price", "ts", "receipt_ts", "size",
                        "trade_id", "epoch"]


def test_lists_of_snapshots_stay_out_of_the_live_gate(spark, monkeypatch):
    """What the gate writes of a batch holds no snapshot list, the entries are deltas as before;
    and the first copy that landing writes is gone."""
    import json
    import os

    from conftest import raw_df
    from marketstream.streaming import live, state

    def snap(seq, *orders):
        return {"type": "l3snapshot", "product_id": "BTC-USD", "sequence": seq,
                "bids": [["10", "1", o] for o in orders], "asks": [["12", "3", "z"]]}

    done = {"type": "done", "product_id": "BTC-USD", "sequence": 2, "order_id": "a", "side": "buy", "price": "10"}
    msgs = [snap(1, "a", "b"), done, snap(5, "c"), done | {"sequence": 6, "order_id": "c"}]
    scan, seen = state.Carried.scan, {}

    def spy(self, name, df, *a, **b):
        seen.setdefault(name, df.columns)
        return scan(self, name, df, *a, **b)

    monkeypatch.setattr(state.Carried, "scan", spy)
    out, states, n = live.replay(spark, raw_df(spark, [json.dumps(m) for m in msgs]), True, False, True,
                                 name="lists", max_rows=3)
    assert n == 2 and not {"bids", "asks"} & set(seen["gate"])
    got = sorted((r.arrival, r.sub, r.order_id, int(r["size"])) for r in out.where("kind = 'l3delta'").collect())
    assert got == [(0, 1, "a", 1), (0, 2, "b", 1), (0, 3, "z", 3), (1, 0, "a", 0),
                   (2, 1, "c", 1), (2, 2, "z", 3), (3, 0, "c", 0)]
    assert [r.order_id for r in state.l3_book(spark, states, n).collect()] == ["z"]
    assert not [f for f in os.listdir(os.path.join(os.path.dirname(states.removeprefix("file:")), "landing"))
                if f.startswith("raw")]
