"""The book at every message against a plain replay: chunks of every size, capped depths,
messages of many changes, two venues, bad rows, snapshots without levels."""

from __future__ import annotations

import json
import random
from decimal import Decimal

import pytest
from conftest import raw_df

from marketstream.operators import living_book as B
from marketstream.operators.parse import parse_messages


def messages(n: int, seed: int) -> list[str]:
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        sym = rnd.choice(["BTC-USD", "BTC-USD", "ETH-USD"])
        if rnd.random() < 0.06:
            def levels():
                return [[str(rnd.randint(1, 30)), rnd.choice(["0", "1", "2.5"])]
                        for _ in range(rnd.choice([0, 3, 25]))]
            m = {"type": "snapshot", "product_id": sym, "bids": levels(), "asks": levels()}
        else:
            m = {"type": "l2update", "product_id": sym, "time": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}Z",
                 "changes": [[rnd.choice(["buy", "sell"]), f"{rnd.randint(1, 30)}.{rnd.choice('05')}0",
                              rnd.choice(["0", "0", "1", "3.25", "-1", "bad"])]
                             for _ in range(rnd.choice([0, 1, 1, 2, 40]))]}
        out.append(json.dumps(m))
    return out


def replay(texts, depth):
    """One message after another: (arrival, symbol) -> book after it and delta of it."""
    books, deltas, now = {}, {}, {}
    for a, text in enumerate(texts):
        m = json.loads(text)
        sym = m["product_id"]
        if m["type"] == "snapshot":
            now[sym] = {"bid": {}, "ask": {}}
            for side in ("bid", "ask"):
                for p, s in m[side + "s"]:
                    now[sym][side][Decimal(p)] = Decimal(s)
            delta = {"bid": None, "ask": None}
        elif sym not in now:
            continue
        else:
            delta = {"bid": [], "ask": []}
            for side, p, s in m["changes"]:
                if s == "bad":
                    continue
                side, p, s = "bid" if side == "buy" else "ask", Decimal(p), Decimal(s)
                if s > 0:
                    now[sym][side][p] = s
                    delta[side].append((p, s))
                elif s == 0 and now[sym][side].pop(p, None) is not None:
                    delta[side].append((p, s))
        books[a] = tuple([(p, now[sym][side][p]) for p in
                          sorted(now[sym][side], reverse=side == "bid")[:depth]]
                         for side in ("bid", "ask"))
        deltas[a] = (delta["bid"], delta["ask"])
    return books, deltas


def pairs(levels):
    return None if levels is None else [(x["price"], x["size"]) for x in levels]


@pytest.mark.parametrize("chunk,depth", [(5, 3), (64, None), (1 << 20, 1)])
def test_every_message_against_a_replay(spark, chunk, depth):
    texts = messages(400, 11)
    books, deltas = replay(texts, depth)
    msgs = B.book_messages(parse_messages(raw_df(spark, texts)), chunk)
    rows = B.records_each(msgs, depth, chunk).collect()
    assert len(rows) == len(books)
    assert {r.arrival: (pairs(r.bid), pairs(r.ask)) for r in rows} == books
    got = B.message_deltas(msgs, chunk).collect()
    assert {r.arrival: (pairs(r.bid), pairs(r.ask)) for r in got} == deltas


def test_chunks_are_bounded_by_changes_not_by_arrivals(spark):
    texts = messages(300, 5)
    dense = B.book_messages(parse_messages(raw_df(spark, texts)), 50)
    sparse = B.book_messages(parse_messages(raw_df(spark, texts).selectExpr(
        "arrival * 1000003 as arrival", "receipt_time", "value")), 50)
    a = sorted((r.arrival, r.chunk) for r in dense.collect())
    assert [(x * 1000003, c) for x, c in a] == sorted((r.arrival, r.chunk) for r in sparse.collect())
    books, _ = replay(texts, 2)
    got = {r.arrival: (pairs(r.bid), pairs(r.ask)) for r in B.records_each(sparse, 2, 50).collect()}
    assert got == {x * 1000003: v for x, v in books.items()}


def test_two_venues_and_the_record_text(spark):
    one, two = messages(60, 1), messages(60, 2)
    both = parse_messages(raw_df(spark, one)).unionByName(
        parse_messages(raw_df(spark, two), exchange="BITSTAMP"))
    got = B.records_each(B.book_messages(both, 16), 4, 16).collect()
    for ex, texts in (("COINBASE", one), ("BITSTAMP", two)):
        assert {r.arrival: (pairs(r.bid), pairs(r.ask)) for r in got if r.exchange == ex} \
            == replay(texts, 4)[0]
    texts = [json.dumps({"type": "snapshot", "product_id": "BTC-USD", "bids": [["10", "1"], ["12.50", "2"]],
                         "asks": [["10000000", "0.000001"]]}),
             json.dumps({"type": "l2update", "product_id": "BTC-USD", "time": "2024-01-01T00:00:09Z",
                         "changes": [["buy", "10.00", "0"], ["sell", "0.000001", "3"]]})]
    rows = B.records_json(B.records_each(B.book_messages(parse_messages(raw_df(spark, texts))))).collect()
    told = [json.loads(r.value) for r in sorted(rows, key=lambda r: r.arrival)]
    assert list(told[0]["bid"].items()) == [("12.5", 2.0), ("10.0", 1.0)]
    assert told[0]["ask"] == {"10000000.0": 1e-06} and told[0]["ts"] == told[0]["receipt_ts"]
    assert list(told[1]["ask"].items()) == [("0.000001", 3.0), ("10000000.0", 1e-06)]
    assert told[1]["bid"] == {"12.5": 2.0} and told[1]["ts"] == 1704067209 * 10 ** 9


def test_levels_cross_arrow_batches_of_any_size(spark):
    """The record builder alone: levels held from earlier batches, snapshots in mid-batch, equal
    places in two chunks, 38-digit prices; the same records whatever the batches."""
    import pyarrow as pa

    big = Decimal("99999999999999999999.999999999999999999")
    row = ("X", "S", 0, None, 0, "bid", Decimal(1), Decimal(7), False, None, None)
    rows = [row]
    for a, side, price, size, snap in [(0, "bid", 2, 3, False), (1, "ask", big, 4, False),
                                       (2, "bid", 1, 0, False), (3, "ask", 5, 0, True),
                                       (4, "bid", big, 1, False), (5, "bid", -2, 1, False)]:
        if snap:
            rows.append(("X", "S", 0, a, -1, None, None, None, True, None, 9))
        rows.append(("X", "S", 0, a, 0, side, Decimal(price), Decimal(size), snap, None, None))
        rows.append(("X", "S", 0, a, B._LAST, None, None, None, snap, a + 10, a + 20))
    rows.append(("X", "S", 1, 6, B._LAST, None, None, None, False, 16, 26))
    dec = pa.decimal128(38, 18)
    schema = pa.schema([("exchange", pa.string()), ("symbol", pa.string()), ("chunk", pa.int64()),
                        ("arrival", pa.int64()), ("pos", pa.int32()), ("side", pa.string()),
                        ("price", dec), ("amount", dec), ("snap", pa.bool_()), ("ts", pa.int64()),
                        ("receipt_ts", pa.int64())])
    table = pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    seen = []
    for n in (1, 2, 3, 100):
        seen.append([r for b in B._each(2)(iter(table.to_batches(max_chunksize=n))) for r in b.to_pylist()])
    got = [([(x["price"], x["size"]) for x in r["bid"]], [(x["price"], x["size"]) for x in r["ask"]])
           for r in seen[0]]
    assert got == [([(2, 3), (1, 7)], []), ([(2, 3), (1, 7)], [(big, 4)]), ([(2, 3)], [(big, 4)]),
                   ([], [(5, 0)]), ([(big, 1)], [(5, 0)]), ([(big, 1), (-2, 1)], [(5, 0)]), ([], [])]
    assert all(s == seen[0] for s in seen)
    assert [(r["arrival"], r["ts"], r["receipt_ts"]) for r in seen[0]] == [(a, a + 10, a + 20) for a in range(7)]
