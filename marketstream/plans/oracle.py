"""DuckDB oracle SQL for every registered query.

These are written independently of the Spark code (plain SQL windows over the whole
partition, no chunking, no JSON round trip) so that the Spark side is never checked
against its own text.  The feed CTEs follow the derived-feed definitions of FIXTURES.md
Appendix A.  Views available: the driver's tables (``events`` is the one used).
"""

from __future__ import annotations

# Fixed values that must equal the venue's (symbol list, exchange id) -- see
# marketstream.schemas for the Spark-side copy.
_SYM = ("CASE {c} WHEN 0 THEN 'BTC-USD' WHEN 1 THEN 'ETH-USD' "
        "WHEN 2 THEN 'AVAX-USD' ELSE 'SOL-USD' END")


def sym(col: str) -> str:
    return _SYM.format(c=col)


BASE = """base AS (
  SELECT event_id AS i, user_id, event_type, ts,
         epoch_us(ts) * 1000 AS ts_ns,
         epoch_us(ts + INTERVAL 1 MILLISECOND) * 1000 AS rcv_ns,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
         CAST(floor(value) AS BIGINT) + 1 AS sz
  FROM events)"""

# ---------------------------------------------------------------- trades / tickers
TRADES_TABLE = f"""WITH {BASE}
SELECT exchange, symbol, side, price, ts, receipt_ts, size, trade_id, epoch FROM (
  SELECT 'COINBASE' AS exchange, {sym('user_id % 4')} AS symbol,
         CASE WHEN i % 2 = 0 THEN 'sell' ELSE 'buy' END AS side,
         CAST(k + 1 AS FLOAT) AS price, ts_ns AS ts, rcv_ns AS receipt_ts,
         CAST(sz AS DOUBLE) AS size, CAST(i AS VARCHAR) AS trade_id, ts_ns AS epoch
  FROM base) t
ORDER BY ts DESC"""

TRADE_RECORD = f"""WITH {BASE}
SELECT {sym('user_id % 4')} AS key,
       to_json(struct_pack(exchange := 'COINBASE', symbol := {sym('user_id % 4')},
               side := CASE WHEN i % 2 = 0 THEN 'sell' ELSE 'buy' END,
               price := CAST(k + 1 AS DOUBLE), ts := ts_ns, receipt_ts := rcv_ns,
               size := CAST(sz AS DOUBLE), trade_id := CAST(i AS VARCHAR)))::VARCHAR AS value
FROM base"""

TRADE_RECORD_FILLED = TRADE_RECORD.replace(
    "trade_id := CAST(i AS VARCHAR)", "trade_id := CASE WHEN i % 7 <> 0 THEN CAST(i AS VARCHAR) ELSE 'none' END")

TRADES_NEWEST = f"""SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY ts DESC, trade_id DESC) AS INTEGER) AS place, symbol, ts, trade_id
  FROM ({TRADES_TABLE}) t) r
WHERE place <= 100"""

TRADES_CLUSTERED = f"""SELECT * FROM ({TRADES_TABLE}) t
WHERE symbol = 'BTC-USD' AND ts >= 1704672000000000000 AND ts < 1705276800000000000"""

# routing feed: click->ticker, purchase->match, signup->activate, view->bogus, error->no type
TICKERS = f"""WITH {BASE}
SELECT 'COINBASE' AS exchange, {sym('user_id % 4')} AS symbol,
       CAST(k + 1 AS DECIMAL(38,18)) AS bid, CAST(k + 2 AS DECIMAL(38,18)) AS ask,
       CASE WHEN i % 10 = 0 THEN rcv_ns ELSE ts_ns END AS ts, rcv_ns AS receipt_ts,
       i AS arrival
FROM base WHERE event_type = 'click'"""

ROUTE_COUNTS = """SELECT route, count(*) AS n FROM (
  SELECT CASE event_type WHEN 'click' THEN 'ticker' WHEN 'purchase' THEN 'trade'
              WHEN 'signup' THEN 'ignored' WHEN 'view' THEN 'unknown_type'
              ELSE 'missing_type' END AS route
  FROM events) r
GROUP BY route"""

INVALID_MESSAGES = """SELECT event_id AS arrival,
       CASE WHEN event_type = 'view' THEN 'unknown_type' ELSE 'missing_type' END AS reason,
       CASE WHEN event_type = 'view' THEN 'bogus' END AS type
FROM events WHERE event_type IN ('view', 'error')"""

TRADES_NORMALISED = f"""WITH {BASE}
SELECT 'COINBASE' AS exchange, {sym('user_id % 4')} AS symbol,
       CASE WHEN i % 2 = 0 THEN 'sell' ELSE 'buy' END AS side,
       CAST(sz AS DECIMAL(38,18)) AS amount, CAST(k + 1 AS DECIMAL(38,18)) AS price,
       ts_ns AS ts, rcv_ns AS receipt_ts, CAST(i AS VARCHAR) AS trade_id, i AS arrival
FROM base WHERE event_type = 'purchase'"""

# subscription: trades + ticker channels for BTC-USD and SOL-USD
SUBSCRIPTION_FILTER = f"""WITH {BASE}
SELECT i AS arrival, {sym('user_id % 4')} AS symbol,
       CASE event_type WHEN 'click' THEN 'ticker' ELSE 'matches' END AS channel
FROM base
WHERE event_type IN ('click', 'purchase') AND user_id % 4 IN (0, 3)"""

PRODUCTS = f"""SELECT DISTINCT {sym('user_id % 4')} AS symbol, {sym('user_id % 4')} AS product_id,
       split_part({sym('user_id % 4')}, '-', 1) AS base, 'USD' AS quote,
       CAST('0.01' AS DECIMAL(38,18)) AS tick_size, 'spot' AS instrument_type
FROM events"""

FEEDS_UNION = f"""WITH {BASE}
SELECT exchange, kind, count(*) AS n FROM (
  SELECT 'COINBASE' AS exchange, 'trade' AS kind FROM base WHERE event_type = 'purchase'
  UNION ALL SELECT 'COINBASE', 'ticker' FROM base WHERE event_type = 'click'
  UNION ALL SELECT 'BITSTAMP', 'trade' FROM base WHERE event_type = 'signup') u
GROUP BY exchange, kind"""

# ---------------------------------------------------------------- L2
L2_MSG = f"""{BASE},
msg AS (
  SELECT i, user_id % 4 AS sym, 0 AS pos, i % 2 AS side, k AS price,
         CASE WHEN event_type = 'error' THEN 0
              WHEN event_type = 'view' AND i % 50 = 7 THEN -1 ELSE sz END AS amt,
         0 AS snap, ts_ns
  FROM base WHERE i % 250 <> 0
  UNION ALL
  SELECT i, user_id % 4, d.d, d.d % 2, (k + d.d * 7) % 100, d.d + 1, 1, NULL
  FROM base CROSS JOIN (VALUES (0), (1), (2), (3), (4)) d(d) WHERE i % 250 = 0),
lv AS (
  SELECT *, sum(CASE WHEN snap = 1 AND pos = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY sym ORDER BY i, pos ROWS UNBOUNDED PRECEDING) AS epoch
  FROM msg),
kept AS (SELECT * FROM lv WHERE epoch > 0 AND amt >= 0),
w AS (
  SELECT *, coalesce(lag(snap = 1 OR amt > 0)
              OVER (PARTITION BY sym, epoch, side, price ORDER BY i, pos), false) AS was
  FROM kept),
book AS (
  SELECT sym, side, price, amt FROM (
    SELECT *, row_number() OVER (PARTITION BY sym, side, price ORDER BY i DESC, pos DESC) AS rn,
              max(epoch) OVER (PARTITION BY sym) AS top
    FROM kept) b
  WHERE rn = 1 AND epoch = top AND (snap = 1 OR amt > 0))"""

L2_BOOK = f"""WITH {L2_MSG}
SELECT {sym('sym')} AS symbol, CASE WHEN side = 0 THEN 'bid' ELSE 'ask' END AS side,
       CAST(price AS DECIMAL(38,18)) AS price, CAST(amt AS DECIMAL(38,18)) AS amount
FROM book"""

L2_DELTAS = f"""WITH {L2_MSG}
SELECT i AS arrival, {sym('sym')} AS symbol, CASE WHEN side = 0 THEN 'bid' ELSE 'ask' END AS side,
       CAST(price AS DECIMAL(38,18)) AS price, CAST(amt AS DECIMAL(38,18)) AS amount,
       ts_ns AS ts
FROM w WHERE snap = 0 AND (amt > 0 OR was)"""

L2_DEPTH = f"""WITH {L2_MSG}
SELECT symbol, side, price, amount, lvl FROM (
  SELECT {sym('sym')} AS symbol, CASE WHEN side = 0 THEN 'bid' ELSE 'ask' END AS side,
         CAST(price AS DECIMAL(38,18)) AS price, CAST(amt AS DECIMAL(38,18)) AS amount,
         CAST(row_number() OVER (PARTITION BY sym, side
              ORDER BY CASE WHEN side = 0 THEN -price ELSE price END) AS BIGINT) AS lvl
  FROM book) d
WHERE lvl <= 10"""

L2_SUMMARY = f"""WITH {L2_MSG}
SELECT {sym('sym')} AS symbol,
       CAST(max(CASE WHEN side = 0 THEN price END) AS DECIMAL(38,18)) AS best_bid,
       CAST(min(CASE WHEN side = 1 THEN price END) AS DECIMAL(38,18)) AS best_ask,
       CAST(count(CASE WHEN side = 0 THEN 1 END) AS BIGINT) AS bid_levels,
       CAST(count(CASE WHEN side = 1 THEN 1 END) AS BIGINT) AS ask_levels,
       CAST(sum(CASE WHEN side = 0 THEN amt ELSE 0 END) AS DECIMAL(38,18)) AS bid_size,
       CAST(sum(CASE WHEN side = 1 THEN amt ELSE 0 END) AS DECIMAL(38,18)) AS ask_size
FROM book GROUP BY sym"""

# Level-2 changes the handler cannot apply (an update before the symbol's first
# snapshot raised in the reference); quarantined per change
L2_REJECTS = f"""WITH {L2_MSG}
SELECT i AS arrival, CAST(pos AS INTEGER) AS pos, {sym('sym')} AS symbol,
       'update_before_snapshot' AS reason
FROM lv WHERE epoch = 0 AND snap = 0"""

BOOK_RECORD = f"""WITH {L2_MSG},
lastmsg AS (
  SELECT user_id % 4 AS sym, arg_max(CASE WHEN i % 250 = 0 THEN rcv_ns ELSE ts_ns END, i) AS ts,
         arg_max(rcv_ns, i) AS receipt_ts
  FROM base GROUP BY user_id % 4),
sides AS (
  SELECT sym,
         coalesce(list(struct_pack(price := CAST(price AS DOUBLE), size := CAST(amt AS DOUBLE))
                       ORDER BY price DESC) FILTER (WHERE side = 0), []) AS bid,
         coalesce(list(struct_pack(price := CAST(price AS DOUBLE), size := CAST(amt AS DOUBLE))
                       ORDER BY price) FILTER (WHERE side = 1), []) AS ask
  FROM book GROUP BY sym)
SELECT {sym('s.sym')} AS key,
       to_json(struct_pack(exchange := 'COINBASE', symbol := {sym('s.sym')}, ts := l.ts,
                           receipt_ts := l.receipt_ts, bid := s.bid, ask := s.ask))::VARCHAR AS value
FROM sides s JOIN lastmsg l ON l.sym = s.sym"""

# the book as of every message: levels whose lifetime covers it, best ten a side
BOOK_RECORDS_EACH = f"""WITH {L2_MSG},
heads AS (
  SELECT i, sym, ts, rcv, epoch FROM (
    SELECT i, user_id % 4 AS sym, CASE WHEN i % 250 = 0 THEN rcv_ns ELSE ts_ns END AS ts,
           rcv_ns AS rcv, sum(CASE WHEN i % 250 = 0 THEN 1 ELSE 0 END)
             OVER (PARTITION BY user_id % 4 ORDER BY i ROWS UNBOUNDED PRECEDING) AS epoch
    FROM base) h WHERE epoch > 0),
lives AS (
  SELECT *, lead(i) OVER (PARTITION BY sym, epoch, side, price ORDER BY i, pos) AS stop FROM kept),
held AS (
  SELECT h.i, l.side, l.price, l.amt, row_number() OVER (
           PARTITION BY h.i, l.side ORDER BY CASE WHEN l.side = 0 THEN -l.price ELSE l.price END) AS r
  FROM heads h JOIN lives l ON l.sym = h.sym AND l.epoch = h.epoch AND l.i <= h.i
       AND (l.stop IS NULL OR l.stop > h.i)
  WHERE l.snap = 1 OR l.amt > 0),
texts AS (
  SELECT i, string_agg('"' || price || '.0":' || amt || '.0', ',' ORDER BY r) FILTER (WHERE side = 0) AS bid,
            string_agg('"' || price || '.0":' || amt || '.0', ',' ORDER BY r) FILTER (WHERE side = 1) AS ask
  FROM held WHERE r <= 10 GROUP BY i)
SELECT h.i AS arrival, {sym('h.sym')} AS key,
       '{{"exchange":"COINBASE","symbol":"' || {sym('h.sym')} || '","ts":' || h.ts || ',"receipt_ts":'
       || h.rcv || ',"bid":{{' || coalesce(t.bid, '') || '}},"ask":{{' || coalesce(t.ask, '') || '}}}}' AS value
FROM heads h LEFT JOIN texts t ON t.i = h.i"""

# one change a message: its delta, or none where it changes nothing
L2_MESSAGE_DELTAS = f"""WITH {L2_MSG},
heads AS (
  SELECT *, sum(CASE WHEN i % 250 = 0 THEN 1 ELSE 0 END)
              OVER (PARTITION BY user_id % 4 ORDER BY i ROWS UNBOUNDED PRECEDING) AS epoch
  FROM base),
changed AS (SELECT i, side, '[[' || price || '.0,' || amt || '.0]]' AS c FROM w
            WHERE snap = 0 AND (amt > 0 OR was))
SELECT h.i AS arrival, {sym('user_id % 4')} AS symbol,
       CASE WHEN h.i % 250 = 0 THEN rcv_ns ELSE ts_ns END AS ts,
       CASE WHEN h.i % 250 <> 0 THEN '{{"bid":' || CASE WHEN c.side = 0 THEN c.c ELSE '[]' END
         || ',"ask":' || CASE WHEN c.side = 1 THEN c.c ELSE '[]' END || '}}' END AS delta
FROM heads h LEFT JOIN changed c ON c.i = h.i WHERE epoch > 0"""

TWO_VENUE_BOOK = f"""WITH {L2_MSG}
SELECT v.exchange, {sym('sym')} AS symbol, CASE WHEN side = 0 THEN 'bid' ELSE 'ask' END AS side,
       CAST(price AS DECIMAL(38,18)) AS price, CAST(amt AS DECIMAL(38,18)) AS amount
FROM book CROSS JOIN (VALUES ('COINBASE'), ('BITSTAMP')) v(exchange)"""

TWO_VENUES_APART = (
    f"SELECT 'COINBASE' AS exchange, a.* FROM ({L2_BOOK}) a UNION ALL "
    "SELECT 'BITSTAMP' AS exchange, b.* FROM ("
    + L2_BOOK.replace("FROM events)", "FROM events WHERE event_id % 2 = 0)") + ") b")

# per event: a short and a bad snapshot level, bad and short changes, a bad ticker, a bad
# trade, a bad order change, an order without an id, a match on an unknown maker, no JSON
REJECTS_ALL = """SELECT source, reason, count(*) AS n FROM events e JOIN (VALUES
    (0, 'l2', 'bad_number'), (1, 'l2', 'bad_number'), (2, 'l2', 'bad_number'),
    (3, 'number', 'bad_number'), (4, 'number', 'bad_number'), (4, 'l3', 'bad_number'),
    (5, 'l3', 'bad_number'), (6, 'l3', 'no_order_id'), (7, 'l3', 'unknown_maker'),
    (8, 'message', 'malformed')) r(m, source, reason) ON e.event_id % 10 = r.m
GROUP BY source, reason"""

# ---------------------------------------------------------------- L3
L3_FEED = f"""{BASE},
m AS (SELECT i, CAST(floor(i / 4) AS BIGINT) AS j, i % 4 AS p,
             CAST(floor(i / 4) AS BIGINT) - 16 * (i % 4) AS o, ts_ns FROM base),
f0 AS (
  SELECT m.*, m.j % 4 AS sym, m.o % 2 AS side, a.k AS price, a.sz,
         1000 + row_number() OVER (PARTITION BY m.j % 4 ORDER BY m.i) AS seq
  FROM m LEFT JOIN base a ON a.i = 4 * m.o),
feed AS (
  SELECT i, sym, seq, o AS oid, ts_ns,
         CASE WHEN o % 11 = 0 AND o >= 32 THEN o - 32 ELSE j END AS taker, side, price, p,
         CASE WHEN o < 0 OR price IS NULL THEN 'activate' WHEN p = 0 THEN 'received'
              WHEN o % 7 = 0 AND p IN (1, 2) THEN 'activate' WHEN p = 1 THEN 'open'
              WHEN p = 2 THEN 'match' WHEN o % 7 = 0 THEN 'done_mkt'
              WHEN o % 3 = 0 THEN 'change' ELSE 'done' END AS typ,
         CASE WHEN p = 2 THEN (CASE WHEN o % 5 = 0 THEN sz
                                    ELSE greatest(1, CAST(floor(sz / 2) AS BIGINT)) END)
              WHEN p = 3 THEN CAST(floor(sz / 4) AS BIGINT) + 1 ELSE sz END AS size,
         CASE WHEN o % 7 = 0 THEN 'market' ELSE 'limit' END AS otype
  FROM f0)"""


def _l3_chain(rows_cte: str) -> str:
    """A.3 over a CTE ``rows_cte`` with (i, sub, sym, epoch, oid, side, price, typ, size)."""
    return f"""
a3 AS (
  SELECT *, sum(CASE WHEN typ = 'open' THEN 1 ELSE 0 END) OVER w AS life,
            sum(CASE WHEN typ IN ('open', 'change') THEN 1 ELSE 0 END) OVER w AS seg
  FROM {rows_cte}
  WINDOW w AS (PARTITION BY sym, epoch, oid ORDER BY i, sub ROWS UNBOUNDED PRECEDING)),
b3 AS (
  SELECT *, sum(CASE WHEN typ IN ('open', 'change') THEN size WHEN typ = 'match' THEN -size
                     ELSE 0 END)
              OVER (PARTITION BY sym, epoch, oid, life, seg ORDER BY i, sub
                    ROWS UNBOUNDED PRECEDING) AS rem
  FROM a3),
c3 AS (SELECT *, (typ = 'done' OR (typ = 'match' AND rem <= 0)) AS fin FROM b3),
d3 AS (
  SELECT *, coalesce(max(CASE WHEN fin THEN 1 ELSE 0 END)
              OVER (PARTITION BY sym, epoch, oid, life ORDER BY i, sub
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS dead
  FROM c3),
live AS (SELECT *, CASE WHEN fin THEN 0 ELSE rem END AS new_size
         FROM d3 WHERE life > 0 AND dead = 0),
l3book AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sym, epoch, oid ORDER BY i DESC, sub DESC) AS rn,
              max(epoch) OVER (PARTITION BY sym) AS top
    FROM live) x
  WHERE rn = 1 AND NOT fin AND epoch = top)"""


L3_ROWS = """l3rows AS (
  SELECT i, 0 AS sub, sym, 0 AS epoch, oid, side, price, typ, size, seq, ts_ns
  FROM feed WHERE typ IN ('open', 'match', 'change', 'done'))"""

L3_BASE = f"{L3_FEED},\n{L3_ROWS},{_l3_chain('l3rows')}"

_SIDE3 = "CASE WHEN side = 0 THEN 'bid' ELSE 'ask' END"

L3_BOOK = f"""WITH {L3_BASE}
SELECT {sym('sym')} AS symbol, {_SIDE3} AS side, CAST(price AS DECIMAL(38,18)) AS price,
       CAST(oid AS VARCHAR) AS order_id, CAST(new_size AS DECIMAL(38,18)) AS size
FROM l3book"""

L3_DELTAS = f"""WITH {L3_BASE}
SELECT i AS arrival, {sym('sym')} AS symbol, {_SIDE3} AS side,
       CAST(price AS DECIMAL(38,18)) AS price, CAST(oid AS VARCHAR) AS order_id,
       CAST(new_size AS DECIMAL(38,18)) AS size, seq AS sequence, ts_ns AS ts
FROM live"""

L3_LEVELS = f"""WITH {L3_BASE}
SELECT {sym('sym')} AS symbol, {_SIDE3} AS side, CAST(price AS DECIMAL(38,18)) AS price,
       CAST(count(*) AS BIGINT) AS orders, CAST(sum(new_size) AS DECIMAL(38,18)) AS size
FROM l3book GROUP BY sym, side, price"""

L3_LEVEL_MAPS = f"""WITH {L3_BASE},
parts AS (
  SELECT sym, side, price, ascii(right(CAST(oid AS VARCHAR), 1)) % 16 AS part,
         '{{' || string_agg('"' || oid || '":' || CAST(new_size AS DOUBLE), ',' ORDER BY CAST(oid AS VARCHAR)) || '}}' AS orders
  FROM l3book GROUP BY ALL),
totals AS (SELECT sym, side, price, count(*) AS n, sum(new_size) AS s FROM l3book GROUP BY ALL)
SELECT {sym('p.sym')} AS symbol, CASE WHEN p.side = 0 THEN 'bid' ELSE 'ask' END AS side,
       CAST(p.price AS DECIMAL(38,18)) AS price, CAST(p.part AS INTEGER) AS part, p.orders,
       CAST(t.n AS BIGINT) AS level_orders, CAST(t.s AS DECIMAL(38,18)) AS level_size
FROM parts p JOIN totals t ON t.sym = p.sym AND t.side = p.side AND t.price = p.price"""

L3_FEED_TYPES = f"""WITH {L3_FEED}
SELECT typ AS kind, count(*) AS n FROM feed GROUP BY typ"""

TRADES_WITH_ORDER_TYPE = f"""WITH {L3_BASE},
ev AS (
  SELECT oid AS order_id, i, 0 AS sub, 'set' AS kind, otype AS typ FROM feed WHERE typ = 'received'
  UNION ALL SELECT oid, i, 0, 'del', NULL FROM feed WHERE typ IN ('done', 'done_mkt')
  UNION ALL SELECT oid, i, 0, 'del', NULL FROM live WHERE typ = 'match' AND fin
  UNION ALL SELECT taker, i, 1, 'q', NULL FROM feed WHERE typ = 'match'),
r AS (
  SELECT *, last_value(CASE WHEN kind = 'set' THEN typ WHEN kind = 'del' THEN '#' END IGNORE NULLS)
              OVER (PARTITION BY order_id ORDER BY i, sub
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ref
  FROM ev)
SELECT CAST(f.i AS VARCHAR) AS trade_id, {sym('f.sym')} AS symbol,
       CASE WHEN f.side = 0 THEN 'sell' ELSE 'buy' END AS side,
       CAST(f.size AS DECIMAL(38,18)) AS amount, CAST(f.price AS DECIMAL(38,18)) AS price,
       f.ts_ns AS ts, nullif(r.ref, '#') AS order_type
FROM feed f JOIN r ON r.kind = 'q' AND r.i = f.i
WHERE f.typ = 'match'"""

TRADES_WITHOUT_L3 = TRADES_WITH_ORDER_TYPE.replace(
    "  UNION ALL SELECT oid, i, 0, 'del', NULL FROM live WHERE typ = 'match' AND fin\n", "")

UNKNOWN_MAKERS = f"""WITH {L3_BASE}
SELECT i AS arrival, {sym('sym')} AS symbol, CAST(oid AS VARCHAR) AS order_id,
       'unknown_maker' AS reason
FROM d3 WHERE typ = 'match' AND NOT (life > 0 AND dead = 0)"""

UNKNOWN_MAKERS_LOSSY = UNKNOWN_MAKERS.replace(
    "FROM feed WHERE typ IN ('open', 'match', 'change', 'done'))",
    "FROM feed WHERE typ IN ('open', 'match', 'change', 'done') AND NOT (typ = 'open' AND oid % 13 = 0))")

# ---------------------------------------------------------------- gate
GATE_ARR = f"""{L3_FEED},
cnt AS (
  SELECT f.i, s.s, sum(CASE WHEN f.sym = s.s THEN 1 ELSE 0 END)
           OVER (PARTITION BY s.s ORDER BY f.i ROWS UNBOUNDED PRECEDING)
         - CASE WHEN f.sym = s.s THEN 1 ELSE 0 END AS c
  FROM feed f CROSS JOIN (VALUES (0), (1), (2), (3)) s(s)),
arr AS (
  SELECT 2 * i + 1 AS a, sym, seq, 0 AS snap FROM feed WHERE i % 997 <> 5
  UNION ALL SELECT 2 * (i + 8) + 2, sym, seq, 0 FROM feed WHERE i % 499 = 3
  UNION ALL SELECT 2 * i, s, 1000 + c, 1 FROM cnt WHERE i % 2000 = 0),
g0 AS (
  SELECT *, sum(snap) OVER (PARTITION BY sym ORDER BY a, snap DESC ROWS UNBOUNDED PRECEDING) AS epoch
  FROM arr),
g1 AS (
  SELECT *, max(seq) OVER (PARTITION BY sym, epoch ORDER BY a, snap DESC
                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last
  FROM g0),
g2 AS (SELECT *, (snap = 0 AND seq > last + 1) AS gap FROM g1),
g3 AS (
  SELECT *, coalesce(max(CASE WHEN gap OR (snap = 1 AND coalesce(seq, 0) = 0) THEN 1 ELSE 0 END)
              OVER (PARTITION BY sym, epoch ORDER BY a, snap DESC
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lost
  FROM g2),
gate AS (
  SELECT *, CASE WHEN snap = 1 THEN 'snapshot' WHEN epoch = 0 OR lost = 1 THEN 'unsynced'
                 WHEN seq <= last THEN 'stale' WHEN gap THEN 'gap' ELSE 'ok' END AS verdict
  FROM g3)"""

SEQ_VERDICTS = f"""WITH {GATE_ARR}
SELECT a AS arrival, {sym('sym')} AS symbol, seq AS sequence, CAST(snap AS BIGINT) AS snap,
       CAST(epoch AS BIGINT) AS epoch, verdict
FROM gate"""

SEQ_GAPS = f"""WITH {GATE_ARR}
SELECT a AS arrival, {sym('sym')} AS symbol, seq AS received, last + 1 AS expected
FROM gate WHERE verdict = 'gap'"""

SEQ_COUNTS = f"""WITH {GATE_ARR}
SELECT verdict, count(*) AS n FROM gate GROUP BY verdict"""


# what the gate accepts, by the type of the feed's message, and level-2
# messages (one per event), which bypass the gate
MIXED_GATED = f"""WITH {GATE_ARR},
taken AS (
  SELECT CASE WHEN g.snap = 1 THEN 'l3snapshot' WHEN f.typ = 'received' THEN 'received'
              WHEN f.typ = 'match' THEN 'trade' WHEN f.typ = 'activate' THEN 'ignored'
              ELSE 'l3' END AS route, g.verdict
  FROM gate g LEFT JOIN feed f ON g.snap = 0 AND f.sym = g.sym AND f.seq = g.seq
  WHERE g.verdict IN ('ok', 'snapshot')),
passed AS (SELECT route, 'bypass' AS verdict FROM (SELECT 'l2' AS route FROM events) q)
SELECT route, verdict, count(*) AS n
FROM (SELECT * FROM taken UNION ALL SELECT * FROM passed) u GROUP BY route, verdict"""


# L3 behind the gate: snapshots hold the symbol's live orders of the ungapped book at the
# snapshot's sequence; they enter as opens in the new epoch; other rows only when ok.
_GATED_ROWS = """snaps AS (SELECT a, sym, seq AS sseq, epoch FROM gate WHERE snap = 1),
sb AS (
  SELECT s.a, s.sym, s.epoch, l.oid, arg_max(l.side, l.i) AS side, arg_max(l.price, l.i) AS price,
         arg_max(l.new_size, l.i) AS size, arg_max(l.fin, l.i) AS fin, s.sseq AS seq
  FROM snaps s JOIN live l ON l.sym = s.sym AND l.seq <= s.sseq
  GROUP BY s.a, s.sym, s.epoch, s.sseq, l.oid),
grows AS (
  SELECT a AS i, 1 AS sub, sym, epoch, oid, side, price, 'open' AS typ, size, seq, NULL AS ts_ns
  FROM sb WHERE NOT fin
  UNION ALL
  SELECT g.a, 0, g.sym, g.epoch, f.oid, f.side, f.price, f.typ, f.size, f.seq, f.ts_ns
  FROM gate g JOIN feed f ON f.sym = g.sym AND f.seq = g.seq
  WHERE g.verdict = 'ok' AND f.typ IN ('open', 'match', 'change', 'done'))"""

_GATED_CHAIN = _l3_chain("grows").replace("a3 AS (", "ga3 AS (").replace("FROM a3", "FROM ga3") \
    .replace("b3 AS (", "gb3 AS (").replace("FROM b3", "FROM gb3") \
    .replace("c3 AS (", "gc3 AS (").replace("FROM c3", "FROM gc3") \
    .replace("d3 AS (", "gd3 AS (").replace("FROM d3", "FROM gd3") \
    .replace("live AS (", "glive AS (").replace("FROM live", "FROM glive") \
    .replace("l3book AS (", "gbook AS (")

L3_GATED_BASE = (f"{L3_FEED},\n{L3_ROWS},{_l3_chain('l3rows')},\n"
                 + GATE_ARR.split(L3_FEED + ",", 1)[1] + ",\n" + _GATED_ROWS + "," + _GATED_CHAIN)

L3_GATED_BOOK = f"""WITH {L3_GATED_BASE}
SELECT {sym('sym')} AS symbol, {_SIDE3} AS side, CAST(price AS DECIMAL(38,18)) AS price,
       CAST(oid AS VARCHAR) AS order_id, CAST(new_size AS DECIMAL(38,18)) AS size
FROM gbook"""

L3_GATED_DELTAS = f"""WITH {L3_GATED_BASE}
SELECT i AS arrival, {sym('sym')} AS symbol, {_SIDE3} AS side,
       CAST(price AS DECIMAL(38,18)) AS price, CAST(oid AS VARCHAR) AS order_id,
       CAST(new_size AS DECIMAL(38,18)) AS size, seq AS sequence, CAST(epoch AS BIGINT) AS epoch
FROM glive WHERE sub = 0"""


# J1 behind the gate: only ok messages; memory per (symbol, epoch, order id)
TRADES_GATED_ORDER_TYPE = f"""WITH {L3_GATED_BASE},
okrows AS (
  SELECT g.a, g.sym, g.epoch, f.* EXCLUDE (sym, seq) FROM gate g
  JOIN feed f ON f.sym = g.sym AND f.seq = g.seq WHERE g.verdict = 'ok'),
gev AS (
  SELECT sym, epoch, oid AS order_id, a, 0 AS sub, 'set' AS kind, otype AS typ FROM okrows WHERE typ = 'received'
  UNION ALL SELECT sym, epoch, oid, a, 0, 'del', NULL FROM okrows WHERE typ IN ('done', 'done_mkt')
  UNION ALL SELECT sym, epoch, oid, i, 0, 'del', NULL FROM glive WHERE typ = 'match' AND fin AND sub = 0
  UNION ALL SELECT sym, epoch, taker, a, 1, 'q', NULL FROM okrows WHERE typ = 'match'),
gr AS (
  SELECT *, last_value(CASE WHEN kind = 'set' THEN typ WHEN kind = 'del' THEN '#' END IGNORE NULLS)
              OVER (PARTITION BY sym, epoch, order_id ORDER BY a, sub
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ref
  FROM gev)
SELECT CAST(o.i AS VARCHAR) AS trade_id, {sym('o.sym')} AS symbol,
       CASE WHEN o.side = 0 THEN 'sell' ELSE 'buy' END AS side,
       CAST(o.size AS DECIMAL(38,18)) AS amount, CAST(o.price AS DECIMAL(38,18)) AS price,
       o.a AS arrival, nullif(gr.ref, '#') AS order_type
FROM okrows o JOIN gr ON gr.kind = 'q' AND gr.a = o.a AND gr.sym = o.sym
WHERE o.typ = 'match'"""


def all_sql() -> dict[str, str]:
    return {
        "trades_table": TRADES_TABLE,
        "trades_stream": TRADES_TABLE,
        "trade_record": TRADE_RECORD,
        "pipeline_trades": TRADES_TABLE,
        "trade_record_filled": TRADE_RECORD_FILLED,
        "trades_newest": TRADES_NEWEST,
        "topic_exactly_once": TRADE_RECORD,
        "trades_clustered": TRADES_CLUSTERED,
        "l3_level_maps": L3_LEVEL_MAPS,
        "trades_without_l3": TRADES_WITHOUT_L3,
        "tickers": TICKERS,
        "route_counts": ROUTE_COUNTS,
        "invalid_messages": INVALID_MESSAGES,
        "trades_normalised": TRADES_NORMALISED,
        "subscription_filter": SUBSCRIPTION_FILTER,
        "products": PRODUCTS,
        "feeds_union": FEEDS_UNION,
        "l2_book": L2_BOOK,
        "l2_deltas": L2_DELTAS,
        "l2_deltas_chunked": L2_DELTAS,
        "two_venue_book": TWO_VENUE_BOOK,
        "two_venues_apart": TWO_VENUES_APART,
        "l2_depth": L2_DEPTH,
        "l2_summary": L2_SUMMARY,
        "book_record": BOOK_RECORD,
        "book_records_each": BOOK_RECORDS_EACH,
        "book_records_each_chunked": BOOK_RECORDS_EACH,
        "l2_message_deltas": L2_MESSAGE_DELTAS,
        "l2_rejects": L2_REJECTS,
        "l2_stream": L2_DELTAS,
        "l3_feed_types": L3_FEED_TYPES,
        "l3_book": L3_BOOK,
        "l3_deltas": L3_DELTAS,
        "l3_deltas_chunked": L3_DELTAS,
        "partitioned_deltas": L3_DELTAS,
        "unknown_makers": UNKNOWN_MAKERS,
        "unknown_makers_lossy": UNKNOWN_MAKERS_LOSSY,
        "rejects_all": REJECTS_ALL,
        "l3_levels": L3_LEVELS,
        "l3_stream": L3_DELTAS,
        "trades_with_order_type": TRADES_WITH_ORDER_TYPE,
        "seq_verdicts": SEQ_VERDICTS,
        "seq_verdicts_chunked": SEQ_VERDICTS,
        "mixed_gated": MIXED_GATED,
        "seq_gaps": SEQ_GAPS,
        "seq_counts": SEQ_COUNTS,
        "seq_stream": SEQ_VERDICTS,
        "l3_gated_book": L3_GATED_BOOK,
        "l3_gated_deltas": L3_GATED_DELTAS,
        "l3_gated_stream": L3_GATED_DELTAS,
        "l3_book_landed_snapshots": L3_GATED_BOOK,
        "rejects_stream": REJECTS_ALL,
        "l2_book_from_state": L2_BOOK,
        "l3_book_from_state": L3_GATED_BOOK,
        "trades_gated_order_type": TRADES_GATED_ORDER_TYPE,
    }
