"""A per-message sequential model of the venue handler, for tests only.

It applies messages one at a time, exactly as the handler semantics read (gate, L2, L3,
order types), and records what the batch operators must produce.  Deliberately naive:
plain dicts, no Spark.
"""

from __future__ import annotations

import json
from decimal import Decimal


def _d(x):
    return Decimal(str(x))


class Replay:
    def __init__(self, gate: bool = False, keep_l3: bool = True):
        self.gate, self.keep_l3 = gate, keep_l3
        self.epoch, self.last, self.lost = {}, {}, {}
        self.l2, self.l2_started = {}, set()
        self.l3 = {}        # symbol -> {order_id: (side, price, size)}
        self.types = {}     # symbol -> {order_id: type}; reset with the symbol's book
        self.untracked = {}  # symbol -> order ids on the book but no longer tracked
        self.verdicts, self.l2_deltas, self.l3_deltas, self.trades = [], [], [], []
        self.rejects = []

    def run(self, messages):
        for arrival, text in messages:
            self.apply(arrival, json.loads(text))
        return self

    def apply(self, a, m):
        sym, seq = m.get("product_id"), m.get("sequence")
        snap = m.get("type") == "l3snapshot"
        if self.gate and sym is not None and (snap or seq is not None):
            if snap:
                self.epoch[sym] = self.epoch.get(sym, 0) + 1
                self.last[sym], self.lost[sym] = seq, not seq
                self.verdicts.append((a, sym, "snapshot"))
            else:
                last = self.last.get(sym)
                if not self.epoch.get(sym) or self.lost.get(sym):
                    v = "unsynced"
                elif seq <= last:
                    v = "stale"
                elif seq > last + 1:
                    v = "gap"
                    self.lost[sym] = True
                else:
                    v = "ok"
                    self.last[sym] = seq
                self.verdicts.append((a, sym, v))
                if v != "ok":
                    return
        t = m.get("type")
        if snap:
            book = self.l3[sym] = {}
            self.types[sym] = {}
            self.untracked[sym] = set()
            for side, key in (("bid", "bids"), ("ask", "asks")):
                for p, s, oid in m.get(key) or []:
                    book[oid] = (side, _d(p), _d(s))
        elif t == "snapshot":
            self.l2_started.add(sym)
            self.l2[sym] = {("bid", _d(p)): _d(q) for p, q in m.get("bids") or []}
            self.l2[sym].update({("ask", _d(p)): _d(q) for p, q in m.get("asks") or []})
        elif t == "l2update":
            for side, p, q in m.get("changes") or []:
                if sym not in self.l2_started:
                    self.rejects.append((a, "update_before_snapshot"))
                    continue
                k = ("bid" if side == "buy" else "ask", _d(p))
                q = _d(q)
                if q == 0 and k in self.l2[sym]:
                    del self.l2[sym][k]
                    self.l2_deltas.append((a, sym, k[0], k[1], q))
                elif q > 0:
                    self.l2[sym][k] = q
                    self.l2_deltas.append((a, sym, k[0], k[1], q))
        elif t in ("match", "last_match"):
            maker = m.get("maker_order_id")
            book = self.l3.setdefault(sym, {})
            side = "ask" if m.get("side") == "sell" else "bid"
            if self.keep_l3:
                if maker in book and maker not in self.untracked.get(sym, ()):
                    left = book[maker][2] - _d(m["size"])
                    if left <= 0:
                        del book[maker]
                        self.types.setdefault(sym, {}).pop(maker, None)
                        self.l3_deltas.append((a, sym, maker, _d(m["price"]), Decimal(0)))
                    else:
                        book[maker] = (side, _d(m["price"]), left)
                        self.l3_deltas.append((a, sym, maker, _d(m["price"]), left))
                else:
                    self.rejects.append((a, "unknown_maker"))
            self.trades.append((a, str(m.get("trade_id")),
                                self.types.get(sym, {}).get(m.get("taker_order_id"))))
        elif t == "open":
            side = "ask" if m.get("side") == "sell" else "bid"
            self.l3.setdefault(sym, {})[m["order_id"]] = (side, _d(m["price"]), _d(m["remaining_size"]))
            self.untracked.setdefault(sym, set()).discard(m["order_id"])
            self.l3_deltas.append((a, sym, m["order_id"], _d(m["price"]), _d(m["remaining_size"])))
        elif t == "done":
            oid = m.get("order_id")
            self.types.setdefault(sym, {}).pop(oid, None)
            book = self.l3.setdefault(sym, {})
            gone = self.untracked.setdefault(sym, set())
            if "price" not in m:
                if oid in book:
                    gone.add(oid)       # untracked: ignored from now on, entry stays
                return
            if oid in book and oid not in gone:
                del book[oid]
                self.l3_deltas.append((a, sym, oid, _d(m["price"]), Decimal(0)))
        elif t == "change":
            if not m.get("price"):
                return
            oid = m["order_id"]
            book = self.l3.setdefault(sym, {})
            if oid in book and oid not in self.untracked.get(sym, ()):
                side = "ask" if m.get("side") == "sell" else "bid"
                book[oid] = (side, _d(m["price"]), _d(m["new_size"]))
                self.l3_deltas.append((a, sym, oid, _d(m["price"]), _d(m["new_size"])))
        elif t == "received":
            self.types.setdefault(sym, {})[m["order_id"]] = m.get("order_type")

    def l2_book(self):
        return sorted((s, k[0], k[1], q) for s, b in self.l2.items() for k, q in b.items())

    def l3_book(self):
        return sorted((s, oid, v[0], v[1], v[2]) for s, b in self.l3.items() for oid, v in b.items())
