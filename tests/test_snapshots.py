"""Snapshots landed apart from the messages: placed by sequence, whenever they come."""

from __future__ import annotations

import json

import pytest
from conftest import raw_df

from marketstream.operators import gate as G
from marketstream.operators import l3 as L3
from marketstream.operators.parse import parse_messages
from marketstream.sources.snapshots import lists_of, merged


def opened(sym, seq):
    return {"type": "open", "product_id": sym, "sequence": seq, "order_id": f"{sym}{seq}",
            "side": "buy", "price": "10", "remaining_size": "1", "time": "2024-01-01T00:00:00Z"}


def snap(sym, seq, *orders):
    return {"type": "l3snapshot", "product_id": sym, "sequence": seq,
            "bids": [["9", "2", o] for o in orders], "asks": []}


@pytest.mark.parametrize("chunk", [2, 1 << 20])
def test_placed_by_sequence(spark, chunk):
    a, b = "BTC-USD", "ETH-USD"
    msgs = [opened(a, 5), opened(b, 3), opened(a, 6), opened(a, 7), opened(b, 4), opened(a, 9),
            opened(a, 10), {"type": "heartbeat"}]
    # late, repeated, out of order; one between nothing, one after all, two before one message
    snaps = [snap(a, 8, "late"), snap(b, 2, "x"), snap(a, 4, "early"), snap(a, 8, "late"),
             snap(a, 3, "older"), snap(b, 9, "after"), snap(None, 1, "no"), snap(a, None, "no")]
    m = parse_messages(raw_df(spark, [json.dumps(x) for x in msgs]))
    s = parse_messages(raw_df(spark, [json.dumps(x) for x in snaps], start=100))
    feed = merged(m, s, chunk)
    got = [(r.symbol, r.sequence, r.route) for r in feed.orderBy("arrival").collect()
           if r.symbol == a]
    S, M = "l3snapshot", "l3"
    assert got == [(a, 4, S), (a, 5, M), (a, 6, M), (a, 7, M), (a, 8, S), (a, 9, M), (a, 10, M)]
    got = [(r.sequence, r.route) for r in feed.where("symbol = 'ETH-USD'").orderBy("arrival").collect()]
    assert got == [(2, S), (3, M), (4, M), (9, S)]
    assert feed.count() == len(msgs) + 4
    from pyspark.sql import functions as F

    v = G.sequence_gate(feed.withColumn("value", F.lit("")), chunk)
    acc = G.accepted(v)
    book = L3.l3_book(L3.l3_states(L3.l3_rows(acc), chunk), acc.select("exchange", "symbol", "epoch"))
    assert sorted((r.symbol, r.order_id) for r in book.collect()) == [
        (a, f"{a}10"), (a, f"{a}9"), (a, "late"), (b, "after")]
    assert merged(m, s.where("false"), chunk).count() == len(msgs)
    assert merged(m.where("false"), s, chunk).count() == 2


def test_lists_are_read_after_the_merge(spark):
    """Snapshots merged without their lists, each landed twice, find them by their sequence."""
    a = "BTC-USD"
    snaps = [snap(a, 8, "p", "q"), snap(a, 4, "r"), snap("ETH-USD", 8, "z")]
    m = parse_messages(raw_df(spark, [json.dumps(opened(a, k)) for k in (5, 9)]))
    s = parse_messages(raw_df(spark, [json.dumps(x) for x in snaps + snaps], start=100))
    feed = merged(m, s.drop(*L3.LISTS))
    assert "bids" not in feed.columns
    got = lists_of(feed.where("route = 'l3snapshot' and sequence = 8"), s).collect()
    whole = {(r.symbol, r.arrival): r.bids for r in merged(m, s).where("sequence = 8").collect()}
    assert {(r.symbol, r.arrival): r.bids for r in got} == whole and len(got) == 2
