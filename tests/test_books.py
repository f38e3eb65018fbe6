"""Batch book / gate / order-type operators against the sequential per-message model
(tests/replay.py), on the derived feeds and on hand-made edge cases."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, raw_df
from marketstream.operators import gate as G
from marketstream.operators import l2 as L2
from marketstream.operators import l3 as L3
from marketstream.operators.parse import parse_messages
from marketstream.sources import feeds
from replay import Replay


def _feed(df):
    return [(r.arrival, r.value) for r in df.orderBy("arrival").collect()]


@pytest.fixture(scope="module")
def small_chunks(spark):
    """Force many chunks per key so the carry path of every scan is exercised."""
    spark.conf.set("marketstream.scan.chunkRows", "64")
    yield
    spark.conf.unset("marketstream.scan.chunkRows")


def test_l2_matches_replay(spark, small_chunks):
    raw = feeds.l2_feed(spark, SF_SMALL)
    model = Replay().run(_feed(raw))
    out = L2.build_l2(parse_messages(raw))
    deltas = sorted((r.arrival, r.symbol, r.side, r.price, r.amount) for r in out["deltas"].collect())
    assert deltas == sorted(model.l2_deltas)
    book = sorted((r.symbol, r.side, r.price, r.amount) for r in out["book"].collect())
    assert book == model.l2_book()
    assert len(book) > 0 and len(deltas) > 0


def test_l3_and_order_types_match_replay(spark, small_chunks):
    raw = feeds.l3_feed(spark, SF_SMALL)
    model = Replay().run(_feed(raw))
    msgs = L3.with_epoch(parse_messages(raw))
    out = L3.build_l3(msgs)
    deltas = sorted((r.arrival, r.symbol, r.order_id, r.price, r.size) for r in out["deltas"].collect())
    assert deltas == sorted(model.l3_deltas)
    book = sorted((r.symbol, r.order_id, r.side, r.price, r.size) for r in out["book"].collect())
    assert book == model.l3_book()
    typed = L3.trades_with_order_type(msgs, out["states"])
    got = sorted((r.arrival, r.trade_id, r.order_type) for r in typed.collect())
    assert got == sorted(model.trades)
    assert {t for _, _, t in got} == {"limit", "market", None}


def test_gate_matches_replay(spark, small_chunks):
    raw = feeds.gapped_feed(spark, SF_SMALL)
    model = Replay(gate=True).run(_feed(raw))
    v = G.sequence_gate(parse_messages(raw))
    got = sorted((r.arrival, r.symbol, r.verdict) for r in v.collect())
    assert got == sorted(model.verdicts)
    assert {x for _, _, x in got} >= {"ok", "snapshot", "unsynced"}


def run_both(spark, msgs, gate=False):
    texts = [json.dumps(m) for m in msgs]
    model = Replay(gate=gate).run(list(enumerate(texts)))
    p = parse_messages(raw_df(spark, texts))
    return model, p


def test_l2_edge_cases(spark):
    msgs = [
        {"type": "l2update", "product_id": "BTC-USD", "time": "2024-01-01T00:00:00Z",
         "changes": [["buy", "10", "1"]]},                                  # before snapshot
        {"type": "snapshot", "product_id": "BTC-USD",
         "bids": [["10", "1"], ["10", "2"], ["9", "0"]], "asks": [["11", "1"]]},  # repeat + zero
        {"type": "l2update", "product_id": "BTC-USD", "time": "2024-01-01T00:00:01Z",
         "changes": [["buy", "9", "0"], ["buy", "8", "0"], ["sell", "11", "-1"],
                     ["sell", "12", "3"]]},
        {"type": "snapshot", "product_id": "ETH-USD", "bids": [], "asks": []},   # empty
        {"type": "l2update", "product_id": "ETH-USD", "time": "2024-01-01T00:00:02Z",
         "changes": [["sell", "5", "2"]]},
    ]
    model, p = run_both(spark, msgs)
    out = L2.build_l2(p)
    assert sorted((r.symbol, r.side, r.price, r.amount) for r in out["book"].collect()) == model.l2_book()
    assert model.l2_book() == [("BTC-USD", "ask", Decimal(11), Decimal(1)),
                               ("BTC-USD", "ask", Decimal(12), Decimal(3)),
                               ("BTC-USD", "bid", Decimal(10), Decimal(2)),
                               ("ETH-USD", "ask", Decimal(5), Decimal(2))]
    deltas = sorted((r.arrival, r.symbol, r.side, r.price, r.amount) for r in out["deltas"].collect())
    assert deltas == sorted(model.l2_deltas)
    assert [r.reason for r in out["rejects"].collect()] == ["update_before_snapshot"]


def test_l3_edge_cases(spark):
    def o(oid, price, size, side="buy"):
        return {"type": "open", "product_id": "BTC-USD", "order_id": oid, "side": side,
                "price": price, "remaining_size": size}
    msgs = [
        {"type": "received", "product_id": "BTC-USD", "order_id": "A", "order_type": "limit"},
        o("A", "10", "5"),
        {"type": "match", "product_id": "BTC-USD", "maker_order_id": "Z", "taker_order_id": "A",
         "side": "buy", "size": "1", "price": "10", "trade_id": 1},          # unknown maker
        {"type": "change", "product_id": "BTC-USD", "order_id": "A", "side": "buy", "price": "",
         "new_size": "1"},                                                   # empty price
        {"type": "done", "product_id": "BTC-USD", "order_id": "Q", "side": "buy", "price": "3"},
        {"type": "change", "product_id": "BTC-USD", "order_id": "A", "side": "buy", "price": "10",
         "new_size": "0"},                                                   # 0-size entry stays
        {"type": "match", "product_id": "BTC-USD", "maker_order_id": "A", "taker_order_id": "B",
         "side": "buy", "size": "1", "price": "10", "trade_id": 2},          # full fill at <= 0
        o("A", "11", "2"),                                                   # re-opened id
        {"type": "received", "product_id": "BTC-USD", "order_id": "C", "order_type": "market"},
        {"type": "match", "product_id": "BTC-USD", "maker_order_id": "A", "taker_order_id": "C",
         "side": "buy", "size": "1", "price": "11", "trade_id": 3},
        {"type": "done", "product_id": "BTC-USD", "order_id": "C", "side": "sell"},  # no price
        {"type": "match", "product_id": "BTC-USD", "maker_order_id": "A", "taker_order_id": "C",
         "side": "buy", "size": "0.5", "price": "11", "trade_id": 4},
    ]
    model, p = run_both(spark, msgs)
    msgs_e = L3.with_epoch(p)
    out = L3.build_l3(msgs_e)
    book = sorted((r.symbol, r.order_id, r.side, r.price, r.size) for r in out["book"].collect())
    assert book == model.l3_book() == [("BTC-USD", "A", "bid", Decimal(11), Decimal("0.5"))]
    deltas = sorted((r.arrival, r.symbol, r.order_id, r.price, r.size) for r in out["deltas"].collect())
    assert deltas == sorted(model.l3_deltas)
    typed = L3.trades_with_order_type(msgs_e, out["states"])
    assert sorted((r.arrival, r.trade_id, r.order_type) for r in typed.collect()) == sorted(model.trades)
    assert [r.arrival for r in L3.unknown_makers(out["states"]).collect()] == [2]
    assert sorted((r.price, r.orders) for r in out["levels"].collect()) == [(Decimal(11), 1)]


def test_gate_zero_snapshot_and_stale(spark):
    def m(seq):
        return {"type": "activate", "product_id": "BTC-USD", "sequence": seq}
    msgs = [m(1), {"type": "l3snapshot", "product_id": "BTC-USD", "sequence": 0, "bids": [], "asks": []},
            m(1), {"type": "l3snapshot", "product_id": "BTC-USD", "sequence": 5, "bids": [], "asks": []},
            m(5), m(6), m(6), m(7), m(9), m(10),
            {"type": "l3snapshot", "product_id": "BTC-USD", "sequence": 20, "bids": [], "asks": []},
            m(21)]
    model, p = run_both(spark, msgs, gate=True)
    got = sorted((r.arrival, r.symbol, r.verdict) for r in G.sequence_gate(p).collect())
    assert got == sorted(model.verdicts)
    assert [v for _, _, v in got] == ["unsynced", "snapshot", "unsynced", "snapshot", "stale", "ok",
                                      "stale", "ok", "gap", "unsynced", "snapshot", "ok"]
    gaps = G.gaps(G.sequence_gate(p)).collect()
    assert [(r.received, r.expected) for r in gaps] == [(9, 8)]


def test_gated_l3_with_snapshot_orders_matches_replay(spark, small_chunks):
    """L3 behind the gate: snapshots carry the ungapped book's resting orders (as-of
    book from interval ranks); only ok rows and snapshots reach the book."""
    raw = feeds.gapped_feed(spark, SF_MID, with_orders=True)     # sf0.001 has one, empty, point
    feed = _feed(raw)
    assert any('"bids":[[' in v for _, v in feed)          # snapshots hold orders
    model = Replay(gate=True).run(feed)
    acc = G.accepted(G.sequence_gate(parse_messages(raw)))
    states = L3.l3_states(L3.l3_rows(acc))
    deltas = sorted((r.arrival, r.symbol, r.order_id, r.price, r.size)
                    for r in L3.l3_deltas(states).where(F.col("sub") == 0).collect())
    assert deltas == sorted(model.l3_deltas)
    book = sorted((r.symbol, r.order_id, r.side, r.price, r.size)
                  for r in L3.l3_book(states, acc.select("symbol", "epoch")).collect())
    assert book == model.l3_book()
    # order types are forgotten when a snapshot starts a new epoch
    typed = sorted((r.arrival, r.trade_id, r.order_type)
                   for r in L3.trades_with_order_type(acc, states).collect())
    assert typed == sorted(model.trades)


def test_book_as_of_points(spark):
    """Orders resting at a point = replaying the feed up to that point's sequence."""
    texts = [json.dumps(m) for m in [
        {"type": "open", "product_id": "X-Y", "order_id": "a", "side": "buy", "price": "1",
         "remaining_size": "2", "sequence": 1},
        {"type": "open", "product_id": "X-Y", "order_id": "b", "side": "sell", "price": "3",
         "remaining_size": "1", "sequence": 2},
        {"type": "match", "product_id": "X-Y", "maker_order_id": "a", "taker_order_id": "t",
         "side": "buy", "size": "2", "price": "1", "sequence": 3},
        {"type": "change", "product_id": "X-Y", "order_id": "b", "side": "sell", "price": "3",
         "new_size": "0.5", "sequence": 4},
        {"type": "open", "product_id": "X-Y", "order_id": "a", "side": "buy", "price": "2",
         "remaining_size": "4", "sequence": 5}]]
    states = L3.l3_states(L3.l3_rows(L3.with_epoch(parse_messages(raw_df(spark, texts)))))
    pts = spark.createDataFrame([("X-Y", p, s) for p, s in [(10, 0), (11, 1), (12, 2), (13, 3),
                                                            (14, 4), (15, 9)]],
                                "symbol string, point long, seq long")
    got = {}
    for r in L3.book_as_of(states, pts).collect():
        got.setdefault(r.point, set()).add((r.order_id, r.price, r.size))
    assert 10 not in got
    assert got[11] == {("a", Decimal(1), Decimal(2))}
    assert got[12] == {("a", Decimal(1), Decimal(2)), ("b", Decimal(3), Decimal(1))}
    assert got[13] == {("b", Decimal(3), Decimal(1))}
    assert got[14] == {("b", Decimal(3), Decimal("0.5"))}
    assert got[15] == {("b", Decimal(3), Decimal("0.5")), ("a", Decimal(2), Decimal(4))}


def test_done_without_price_untracks_but_keeps_entry(spark):
    """The order leaves the order map, not the book: later match / change / priced
    done on it are ignored (the match is quarantined) until it is opened again."""
    from marketstream.streaming import live, state

    def m(**kw):
        return dict(kw, product_id="BTC-USD")
    msgs = [m(type="open", order_id="A", side="buy", price="10", remaining_size="5"),
            m(type="open", order_id="B", side="sell", price="12", remaining_size="1"),
            m(type="done", order_id="A", side="buy"),                          # untrack A
            m(type="match", maker_order_id="A", taker_order_id="T", side="buy", size="1",
              price="10", trade_id=1),                                        # unknown maker
            m(type="change", order_id="A", side="buy", price="10", new_size="2"),   # ignored
            m(type="done", order_id="A", side="buy", price="10"),              # ignored
            m(type="done", order_id="B", side="sell", price="12"),
            m(type="open", order_id="B", side="sell", price="13", remaining_size="3")]
    model, p = run_both(spark, msgs)
    e = L3.with_epoch(p)
    out = L3.build_l3(e)
    book = sorted((r.symbol, r.order_id, r.side, r.price, r.size) for r in out["book"].collect())
    assert book == model.l3_book() == [("BTC-USD", "A", "bid", Decimal(10), Decimal(5)),
                                       ("BTC-USD", "B", "ask", Decimal(13), Decimal(3))]
    assert sorted((r.arrival, r.symbol, r.order_id, r.price, r.size)
                  for r in out["deltas"].collect()) == sorted(model.l3_deltas)
    assert [r.arrival for r in L3.unknown_makers(out["states"]).collect()] == [3]
    # the live books agree, in batches of three messages
    raw = raw_df(spark, [json.dumps(x) for x in msgs])
    o, state_dir, n = live.replay(spark, raw, False, False, True, name="kill", max_rows=3)
    got = sorted((r.arrival, r.symbol, r.order_id, r.price, r.size)
                 for r in o.where(F.col("kind") == "l3delta").collect())
    assert got == sorted(model.l3_deltas) and n == 3
    assert [r.arrival for r in o.where(F.col("reason") == "unknown_maker").collect()] == [3]
    kept = sorted((r.symbol, r.order_id, r.side, r.price, r.size)
                  for r in state.l3_book(spark, state_dir, n).collect())
    assert kept == book


def test_the_final_book_reads_the_latest_epoch_only(spark, monkeypatch):
    """The gated book scans the orders of each book's latest epoch, and equals the book of all."""
    from marketstream.plans import queries

    def snap(seq, oid):
        return {"type": "l3snapshot", "product_id": "BTC-USD", "sequence": seq,
                "bids": [["10", "1", oid]], "asks": []}

    def opened(seq, oid):
        return {"type": "open", "product_id": "BTC-USD", "sequence": seq, "order_id": oid,
                "side": "sell", "price": "11", "remaining_size": "2"}

    msgs = [snap(1, "a"), opened(2, "b"), snap(5, "c"), opened(6, "d")]
    acc = G.accepted(G.sequence_gate(parse_messages(raw_df(spark, [json.dumps(m) for m in msgs]))))
    want = L3.l3_book(L3.l3_states(L3.l3_rows(acc)), acc.select(*L3.BOOK, "epoch")).drop("exchange")
    l3_states, seen = L3.l3_states, []
    monkeypatch.setattr(L3, "l3_states", lambda rows, *a, **b: seen.append(rows) or l3_states(rows, *a, **b))
    got = queries._final_book(acc)
    assert {r.order_id for r in got.collect()} == {"c", "d"}
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r.epoch for r in seen[0].select("epoch").collect()} == {2}


def test_states_of_messages_need_only_the_snapshot_entries_that_they_name(spark):
    """Snapshots of 200 orders of which messages name a few: the other entries take no part in
    the scans, and the messages' states are those with all entries."""
    from marketstream.schemas import L3_SNAPSHOT_TYPE

    sym = "BTC-USD"

    def snapshot(seq, first):
        orders = [["10", str(k % 7 + 1), f"o{k}"] for k in range(first, first + 200)]
        return {"type": L3_SNAPSHOT_TYPE, "product_id": sym, "sequence": seq,
                "bids": orders[:120] + [["10", "9", "o3"], ["bad", "1", "o4"], ["10"]], "asks": orders[120:]}

    def match(seq, oid, size):
        return {"type": "match", "product_id": sym, "sequence": seq, "maker_order_id": oid, "trade_id": seq,
                "taker_order_id": "t", "side": "buy", "price": "10", "size": size, "time": "2024-01-01T00:00:00Z"}

    feed = [match(1, "o1", "1"), snapshot(2, 0), match(3, "o3", "2"), match(4, "o4", "99"), match(5, "o4", "1"),
            {"type": "done", "product_id": sym, "sequence": 6, "order_id": "o150", "side": "sell", "price": "10",
             "time": "2024-01-01T00:00:00Z"},
            match(7, "gone", "1"), snapshot(8, 100), match(9, "o3", "1"), match(10, "o299", "1"), match(11, None, "1")]
    msgs = L3.with_epoch(parse_messages(raw_df(spark, [json.dumps(m) for m in feed])), 4)
    every, named = L3.l3_rows(msgs), L3.l3_named_rows(msgs)
    assert sorted(r.order_id for r in named.where("sub > 0").collect()) == ["o150", "o299"] + ["o3"] * 3 + ["o4"] * 2
    assert every.where("sub > 0").count() > 400

    def states(rows):
        return sorted(map(str, L3.l3_states(rows, 4).where("sub = 0").collect()))
    assert states(named) == states(every) and len(states(named)) == 8


def test_books_as_of_are_the_rows_of_book_as_of(spark, monkeypatch):
    """One row per point, best first, ties by id, in runs of two points; a point may be a struct."""
    monkeypatch.setattr(L3, "POINTS", 2)
    msgs, seq = [], 0
    for k in range(40):
        seq += 1
        msgs.append({"type": "open", "product_id": "X-Y" if k % 3 else "Z-Y", "order_id": f"o{k}", "sequence": seq,
                     "side": "buy" if k % 2 else "sell", "price": str(k % 5 + 1), "remaining_size": str(k + 1)})
        if k % 4 == 3:
            seq += 1
            msgs.append({"type": "done", "product_id": msgs[-3]["product_id"], "order_id": msgs[-3]["order_id"],
                         "side": msgs[-3]["side"], "price": msgs[-3]["price"], "sequence": seq})
    states = L3.l3_states(L3.l3_rows(L3.with_epoch(parse_messages(raw_df(spark, [json.dumps(m) for m in msgs])))))
    pts = spark.createDataFrame([(s, p, q) for s in ("X-Y", "Z-Y", "N-N") for p, q in enumerate(range(0, 60, 7))],
                                "symbol string, point long, seq long")
    want = {}
    for r in L3.book_as_of(states, pts).collect():
        want.setdefault((r.symbol, r.point), {}).setdefault(r.side, []).append((r.price, r.order_id, r["size"]))
    got = L3.books_as_of(states, pts.withColumn("point", F.struct("point", "seq")))
    rows = got.select("symbol", "point.*", "bids", "asks").collect()
    assert len(rows) == pts.count() and len(want) > 10
    for r in rows:
        for side, orders in (("bid", r.bids), ("ask", r.asks)):
            w = sorted(want.get((r.symbol, r.point), {}).get(side, []), key=lambda x: x[:2], reverse=side == "bid")
            assert [(Decimal(p), o, Decimal(s)) for p, s, o in orders or []] == w


def test_lists_of_snapshots_pass_by_the_gate(spark, monkeypatch):
    """The gate and its scans carry no snapshot list; the accepted snapshots read theirs later."""
    from marketstream.plans import queries

    gate, seen = G.sequence_gate, []
    monkeypatch.setattr(G, "sequence_gate", lambda p, *a, **b: seen.append(p.columns) or gate(p, *a, **b))
    raw = feeds.gapped_feed(spark, SF_MID, with_orders=True)
    all_rows = L3.l3_rows(G.accepted(gate(parse_messages(raw))))
    acc, lists = queries._accepted_l3(spark, SF_MID)
    assert seen and not {"bids", "asks"} & set(seen[0])
    got = L3.l3_rows(acc, lists)
    assert got.columns == all_rows.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, all_rows.collect()))


def test_unnamed_entries_are_dropped_where_they_are_read(spark):
    """Of 3 000 snapshot entries only those whose bit a message set go to the join by order."""
    orders = [["10", "1", f"o{k}"] for k in range(3000)]
    feed = [{"type": "l3snapshot", "product_id": "BTC-USD", "sequence": 1, "bids": orders, "asks": []},
            {"type": "done", "product_id": "BTC-USD", "sequence": 2, "order_id": "o7", "side": "buy", "price": "10"}]
    msgs = L3.with_epoch(parse_messages(raw_df(spark, [json.dumps(m) for m in feed])))
    bits = [0] * L3.NAMED_WORDS
    b = spark.range(1).select(L3._named_bit(F.lit("o7"))).first()[0]
    bits[b // 64] = (1 << b % 64) - (1 << 64 if b % 64 == 63 else 0)
    sets = spark.createDataFrame([("COINBASE", "BTC-USD", 1, bits)], "exchange string, symbol string, epoch long, _bits array<long>")
    left = {r.order_id for r in L3._entries(L3._listed(msgs, None, sets), "_bits").collect()}
    assert "o7" in left and len(left) < 20
    assert [r.order_id for r in L3.l3_named_rows(msgs).where("sub > 0").collect()] == ["o7"]
