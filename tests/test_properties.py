"""Property-based checks: random message sequences through the batch
operators equal the sequential model; verdicts partition the gated input; the book never
holds a removed level."""

from __future__ import annotations

import json

from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import raw_df
from marketstream.operators import gate as G
from marketstream.operators import l2 as L2
from marketstream.operators import l3 as L3
from marketstream.operators.parse import parse_messages
from replay import Replay

SYMS = ["BTC-USD", "ETH-USD"]
_SETTINGS = settings(max_examples=10, deadline=None,
                     phases=[Phase.explicit, Phase.reuse, Phase.generate],
                     suppress_health_check=[HealthCheck.function_scoped_fixture,
                                            HealthCheck.too_slow])


@st.composite
def l3_messages(draw):
    n = draw(st.integers(5, 40))
    out = []
    for _ in range(n):
        sym = draw(st.sampled_from(SYMS))
        oid = draw(st.sampled_from(["a", "b", "c", "d"]))
        side = draw(st.sampled_from(["buy", "sell"]))
        price = str(draw(st.integers(1, 4)))
        size = str(draw(st.integers(0, 5)))
        kind = draw(st.sampled_from(["open", "match", "change", "done", "done_mkt", "received"]))
        if kind == "open":
            m = {"type": "open", "order_id": oid, "side": side, "price": price, "remaining_size": size}
        elif kind == "match":
            m = {"type": "match", "maker_order_id": oid, "taker_order_id": draw(st.sampled_from("abcd")),
                 "side": side, "price": price, "size": size, "trade_id": len(out)}
        elif kind == "change":
            m = {"type": "change", "order_id": oid, "side": side,
                 "price": draw(st.sampled_from([price, ""])), "new_size": size}
        elif kind == "done":
            m = {"type": "done", "order_id": oid, "side": side, "price": price}
        elif kind == "done_mkt":
            m = {"type": "done", "order_id": oid, "side": side}
        else:
            m = {"type": "received", "order_id": oid, "order_type": draw(st.sampled_from(["limit", "market"]))}
        m["product_id"] = sym
        out.append(m)
    return out


@st.composite
def l2_messages(draw):
    n = draw(st.integers(3, 30))
    out = []
    for _ in range(n):
        sym = draw(st.sampled_from(SYMS))
        lv = st.lists(st.tuples(st.integers(1, 5), st.integers(0, 3)), max_size=3)
        if draw(st.integers(0, 4)) == 0:
            out.append({"type": "snapshot", "product_id": sym,
                        "bids": [[str(p), str(a)] for p, a in draw(lv)],
                        "asks": [[str(p), str(a)] for p, a in draw(lv)]})
        else:
            ch = draw(st.lists(st.tuples(st.sampled_from(["buy", "sell"]), st.integers(1, 5),
                                         st.integers(-1, 3)), min_size=1, max_size=3))
            out.append({"type": "l2update", "product_id": sym,
                        "time": "2024-01-01T00:00:00Z",
                        "changes": [[s, str(p), str(a)] for s, p, a in ch]})
    return out


def _run(spark, msgs, gate=False):
    texts = [json.dumps(m) for m in msgs]
    return Replay(gate=gate).run(list(enumerate(texts))), parse_messages(raw_df(spark, texts))


@_SETTINGS
@given(msgs=l3_messages())
def test_random_l3_equals_model(spark, msgs):
    spark.conf.set("marketstream.scan.chunkRows", "4")
    try:
        model, p = _run(spark, msgs)
        e = L3.with_epoch(p)
        out = L3.build_l3(e)
        assert sorted((r.arrival, r.symbol, r.order_id, r.price, r.size)
                      for r in out["deltas"].collect()) == sorted(model.l3_deltas)
        assert sorted((r.symbol, r.order_id, r.side, r.price, r.size)
                      for r in out["book"].collect()) == model.l3_book()
        typed = L3.trades_with_order_type(e, out["states"])
        assert sorted((r.arrival, r.trade_id, r.order_type) for r in typed.collect()) == \
            sorted(model.trades)
    finally:
        spark.conf.unset("marketstream.scan.chunkRows")


@_SETTINGS
@given(msgs=l2_messages())
def test_random_l2_equals_model_and_no_removed_level(spark, msgs):
    spark.conf.set("marketstream.scan.chunkRows", "3")
    try:
        model, p = _run(spark, msgs)
        out = L2.build_l2(p)
        book = sorted((r.symbol, r.side, r.price, r.amount) for r in out["book"].collect())
        assert book == model.l2_book()
        deltas = out["deltas"].collect()
        assert sorted((r.arrival, r.symbol, r.side, r.price, r.amount) for r in deltas) == \
            sorted(model.l2_deltas)
        # a level removed by an update after the symbol's last snapshot is not on the book
        last_snap = {m["product_id"]: i for i, m in enumerate(msgs) if m["type"] == "snapshot"}
        last = {}
        for r in sorted(deltas, key=lambda r: (r.arrival, r.pos)):
            if r.arrival > last_snap.get(r.symbol, -1):
                last[(r.symbol, r.side, r.price)] = r.amount
        on_book = {(s, side, p) for s, side, p, _ in book}
        assert not any(a == 0 and k in on_book for k, a in last.items())
    finally:
        spark.conf.unset("marketstream.scan.chunkRows")


@_SETTINGS
@given(seqs=st.lists(st.tuples(st.sampled_from(SYMS), st.integers(0, 12), st.booleans()),
                     min_size=3, max_size=40))
def test_random_gate_equals_model_and_partitions_input(spark, seqs):
    msgs = [{"type": "l3snapshot" if snap else "activate", "product_id": s, "sequence": q,
             "bids": [], "asks": []} if snap else
            {"type": "activate", "product_id": s, "sequence": q} for s, q, snap in seqs]
    spark.conf.set("marketstream.scan.chunkRows", "5")
    try:
        model, p = _run(spark, msgs, gate=True)
        v = G.sequence_gate(p)
        got = sorted((r.arrival, r.symbol, r.verdict) for r in v.collect())
        assert got == sorted(model.verdicts)
        assert len(got) == len(msgs)                                    # one verdict per message
        assert v.where(F.col("verdict").isin(*G.VERDICTS)).count() == len(msgs)
    finally:
        spark.conf.unset("marketstream.scan.chunkRows")
